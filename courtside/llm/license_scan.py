"""Licence scans by a positional rare-token index, with DataFrame operations only.

The templates (licence lines and, for the base labels, bare phrases) are indexed by word and position. One aggregation
over all documents counts in how many each template word occurs; the ``rare`` words with the highest inverse document
frequency of each template's key phrase are its anchors, ranked by rarity, and each rank has an index of its own. In a file,
every anchor word met looks up its postings; file position minus template position is where a copy of the template would
start. The starts that one rank's postings give are intersected with those of the next (which is looked up only where any
are left), so a start is looked at only if all anchors of the template stand at the right distances. It is verified in the file's words: the template's mandatory key
phrase must stand there in full and the share of the template's IDF weight found in place must reach ``min_share``.

Nothing is shuffled but the document frequencies (a row per template word and task), which also are all that reaches the
driver: at most the templates' vocabulary. The scan is one projection over whole texts, so hot sources and long files
only cost their own tokens.

Defined cases: a null text is an empty one: no words, no labels, score 0; repeated rows give repeated results; extra
columns are not read; an empty table gives an empty result. Where every template word is in every document, IDF is still
positive (it is log((n + 1) / (df + 1)) + 1).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import ascii_lower

#: Words are runs of anything but these (ASCII without digits and letters).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    #: The words that must all stand in place.
    key: str
    #: A base template is a bare phrase; it gives a base label and is counted.
    base: bool = False


# Licence phrases and lines.
TEMPLATES = (
    Template("mit", "mit license", "mit license", True),
    Template("apache", "apache license", "apache license", True),
    Template("gpl", "general public license", "general public license", True),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "licensed under the mit license", "mit license"),
    Template("apache", "licensed under the apache license version 2 0", "apache license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("gpl", "this work is licensed under the gnu general public license version 3", "general public license"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    Template("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    Template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc0", "released under cc0 1 0 universal public domain dedication", "cc0 1 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    Template("bsd", "released under the bsd license", "bsd license"),
    Template("isc", "licensed under the isc license", "isc license"),
    Template("mpl-2.0", "mozilla public license version 2 0", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
MIN_SHARE = 0.5
#: Anchors for each template.
RARE = 2
#: Templates become part of the plan, so a table of them is bounded.
MAX_TEMPLATES = 1000


def words_of(text: Column) -> Column:
    """The lower-cased words of a text, in order."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS, -1), "")


def read_templates(table: DataFrame) -> tuple[Template, ...]:
    """The templates of a table (label, words, key, base) of at most MAX_TEMPLATES rows, which is checked."""
    rows = table.select("label", "words", "key", "base").limit(MAX_TEMPLATES + 1).collect()
    if len(rows) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    for r in rows:
        if f" {r['key']} " not in f" {r['words']} ":
            raise ValueError(f"the key phrase {r['key']!r} is not in its template")
    return tuple(Template(r["label"], r["words"], r["key"], r["base"]) for r in rows)


def document_frequencies(docs: DataFrame, text_col: str, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """How many rows there are, and how many hold each word of the vocabulary."""
    held = F.array_intersect(F.split(F.col(text_col), SEPARATORS, -1), F.array(*map(F.lit, vocabulary)))
    lowered = docs.select(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias(text_col))
    rows = lowered.select(F.explode(F.concat(held, F.array(F.lit("")))).alias("w")).groupBy("w").count().collect()
    found = {r["w"]: r["count"] for r in rows}
    return found.pop("", 0), found


def key_at(t: Template) -> int:
    words, key = t.words.split(), t.key.split()
    return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES, min_share: float = MIN_SHARE, rare: int = RARE) -> DataFrame:
    """One row per row of docs: id, n_words, n_base, first_word, last_word, base_labels, labels, score and found.

    found: array of (label, base, start, share), one for each verified start of a template. score is the largest share of
    a template that is no bare phrase, else 0.
    """
    docs = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    vocabulary = sorted({w for t in templates for w in t.words.split()})
    n, df = document_frequencies(docs, "_text", vocabulary)
    idf = {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1 for w in vocabulary}
    ranks: list[list[tuple[str, int, int]]] = [[] for _ in range(rare)]
    for k, t in enumerate(templates):
        # anchors lie in the key phrase, which must stand in full, so no verified start is missed
        words, key = t.words.split(), range(key_at(t), key_at(t) + len(t.key.split()))
        rarest = sorted(key, key=lambda i: (-idf[words[i]], i))
        for r, own in enumerate(ranks):
            i = rarest[min(r, len(rarest) - 1)]
            own.append((words[i], k, i))
    index = [F.array(*[F.struct(F.lit(w).alias("w"), F.lit(k).alias("k"), F.lit(i).alias("i")) for w, k, i in own]) for own in ranks]
    anchors = [sorted({w for w, _, _ in own}) for own in ranks]

    def verify(c: Column) -> Column:
        """The share of the template at its start, or null where its key phrase isn't there."""
        case = None
        for k, t in enumerate(templates):
            words, at, key = t.words.split(), key_at(t), t.key.split()
            word = lambda i, s=c["s"]: F.get(F.col("_words"), s + i)
            whole = sum(idf[w] for w in words)
            share = F.lit(0.0)
            for i, w in enumerate(words):
                share = share + F.when((c["s"] + i >= 0) & F.coalesce(word(i) == w, F.lit(False)), F.lit(idf[w] / whole)).otherwise(0.0)
            here = F.lit(True)
            for i, w in enumerate(key):
                here = here & F.coalesce(word(at + i) == w, F.lit(False))
            branch = F.when(here, F.least(share, F.lit(1.0)))
            case = F.when(c["k"] == k, branch) if case is None else case.when(c["k"] == k, branch)
        return case

    def starts(r: int) -> Column:
        """(template, start) of every posting of rank r that its anchor words look up."""
        places = F.filter(F.sequence(F.lit(0), F.size("_words") - 1), lambda p: F.get(F.col("_words"), p).isin(anchors[r]))
        met = lambda p: F.filter(F.col(f"_index{r}"), lambda e: e["w"] == F.get(F.col("_words"), p))
        return F.flatten(F.transform(places, lambda p: F.transform(met(p), lambda e: F.struct(e["k"].alias("k"), (p - e["i"]).alias("s")))))

    none = F.array().cast("array<struct<k:int,s:int>>")
    found = (
        docs.withColumn("_text", F.coalesce("_text", F.lit("")))
        .withColumn("_words", words_of(F.col("_text")))
        .withColumns({f"_index{r}": own for r, own in enumerate(index)})
        .withColumn("_starts", F.when(F.arrays_overlap("_words", F.array(*map(F.lit, anchors[0]))), F.array_distinct(starts(0))).otherwise(none))
    )
    for r in range(1, rare):
        found = found.withColumn("_starts", F.when(F.size("_starts") > 0, F.array_intersect("_starts", starts(r))).otherwise(none))
    found = (
        found
        .withColumn("_seen", F.filter(F.transform("_starts", lambda c: F.struct(c["k"].alias("k"), c["s"].alias("s"), verify(c).alias("share"))), lambda c: c["share"].isNotNull() & ((c["share"] >= min_share) | F.lit(min_share <= 0))))
    )
    label = F.array(*[F.lit(t.label) for t in templates])
    is_base = F.array(*[F.lit(t.base) for t in templates])
    found = found.withColumn("found", F.transform("_seen", lambda c: F.struct(F.get(label, c["k"]).alias("label"), F.get(is_base, c["k"]).alias("base"), c["s"].alias("start"), c["share"].alias("share"))))
    base = F.filter("found", lambda c: c["base"])
    names = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda c: c["label"]))), ",")
    return found.select(
        id_col,
        F.size("_words").cast("long").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda c: c["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda c: c["start"])).cast("long").alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform(F.filter("found", lambda c: ~c["base"]), lambda c: c["share"])), F.lit(0.0)).alias("score"),
        "found",
    )
