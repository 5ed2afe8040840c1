"""URL allow and block rules as a sort-merge range join over reversed-host keys.

A rule (host, path) fits a url whose host is the rule's host or one of its subdomains and whose path starts with the
rule's path. Written with its labels reversed and each followed by a dot (``www.example.org`` -> ``org.example.www.``),
a host and all its subdomains form one interval of keys: those that start with the rule's key. Host key and path together
(``org.example./en/1``) are the canonical key of a rule; the urls of a host whose path starts with the rule's are the interval of
keys that start with it. Intervals of either kind nest or are disjoint, so a sweep over sorted keys keeps a stack of the
active rules:

1. a sweep over the urls' hosts gives each url the rule hosts that enclose its own;
2. each of these, with the url's path, is a probe, and a sweep over the sorted probes against the sorted canonical keys leaves the
   longest rule of that host on top of the stack; the longest rule of a url's probes wins.

So thousands of path rules at one host cost a url no more than their nesting. Every task sorts each Arrow batch of urls and
sweeps it; urls are never shuffled, so a hot host costs nothing. Rules are broadcast in blocks of at most ``block_bytes``;
with more rules each further block is a job of its own over the written result of the one before, so one block at a time is
in memory, and the longest fitting rule of all blocks wins.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits no rule; repeated rows give
repeated results; equal rules given twice count once (block wins over allow); a rule whose path is neither empty nor begins
with ``/``, or whose host is empty, fits nothing; extra columns are not read; an empty table gives an empty result. Ties in length (host plus path) go
to the longer host, then to the smaller text.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import ascii_lower, durable

#: Verdict of a url that no rule fits.
DEFAULT_VERDICT = "allow"
BLOCK_BYTES = 32 << 20
#: A sweep that would step over more keys than this looks its place up instead.
JUMP = 64


def reversed_key(host: str) -> str:
    """``www.example.org`` -> ``org.example.www.``; an empty host has the empty key."""
    return ".".join(reversed(host.split("."))) + "." if host else ""


class Intervals:
    """Sorted keys, each the interval of all texts that start with it, with the interval that encloses it next."""

    def __init__(self, keys: Iterable[str]) -> None:
        self.keys = sorted(set(keys))
        self.parent: list[int] = []
        stack: list[int] = []
        for i, k in enumerate(self.keys):
            while stack and not k.startswith(self.keys[stack[-1]]):
                stack.pop()
            self.parent.append(stack[-1] if stack else -1)
            stack.append(i)

    def enclosing(self, i: int) -> list[int]:
        """i and the intervals around it, outermost first."""
        out = []
        while i >= 0:
            out.append(i)
            i = self.parent[i]
        return out[::-1]

    def sweep(self, probes: list[str]) -> Iterator[int]:
        """For each of the sorted probes the innermost interval that holds it, or -1."""
        keys, stack, at = self.keys, [], 0
        for probe in probes:
            if at + JUMP < len(keys) and keys[at + JUMP] <= probe:
                at = bisect_right(keys, probe)
                stack = self.enclosing(at - 1)
            while at < len(keys) and keys[at] <= probe:
                while stack and not keys[at].startswith(keys[stack[-1]]):
                    stack.pop()
                stack.append(at)
                at += 1
            while stack and not probe.startswith(keys[stack[-1]]):
                stack.pop()
            yield stack[-1] if stack else -1


class RuleSweep:
    """The rules of a block."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]) -> None:
        # key -> (length, length of the host, text, verdict); block sorts after allow and so replaces it
        by_key = {reversed_key(h) + p: (len(h + p), len(h), h + p, v) for h, p, v in sorted(set(rules)) if h and p[:1] in ("", "/")}
        self.hosts = Intervals(k[: k.index("/")] if "/" in k else k for k in by_key)
        self.full = Intervals(by_key)
        self.rules = [by_key[k] for k in self.full.keys]

    def sweep(self, keys: list[str], paths: list[str]) -> tuple[list[str | None], list[str | None]]:
        """The winning rule and verdict of each (host key, path)."""
        order = sorted(range(len(keys)), key=keys.__getitem__)
        probes: list[tuple[str, int]] = []
        for row, inner in zip(order, self.hosts.sweep([keys[i] for i in order]), strict=True):
            probes += [(self.hosts.keys[i] + paths[row], row) for i in self.hosts.enclosing(inner)]
        probes.sort()
        best: dict[int, tuple] = {}
        for (_, row), top in zip(probes, self.full.sweep([p for p, _ in probes]), strict=True):
            if top >= 0:
                size, host, text, says = self.rules[top]
                found = (-size, -host, text, says)
                if row not in best or found < best[row]:
                    best[row] = found
        won = [best.get(i, (0, 0, None, None)) for i in range(len(keys))]
        return [w[2] for w in won], [w[3] for w in won]


def blocks(rules: list[tuple[str, str, str]], block_bytes: int = BLOCK_BYTES) -> list[list[tuple[str, str, str]]]:
    out: list[list[tuple[str, str, str]]] = [[]]
    held = 0
    for r in rules:
        cost = sum(len(x.encode()) for x in r) + 200
        if held + cost > block_bytes and out[-1]:
            out.append([])
            held = 0
        out[-1].append(r)
        held += cost
    return out


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT_VERDICT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of pages: id, host, path, the longest fitting rule (else null) and the verdict (else default).

    rules: (host, path, "allow" | "block") with a lower-case host.
    """
    found = pages.select(F.col(id_col), F.coalesce(F.col(url_col), F.lit("")).alias("_url"))
    rest = F.when(F.locate("://", "_url") > 0, F.expr("substring(_url, locate('://', _url) + 3)")).otherwise(F.lit(""))
    split = found.select(F.col(id_col), rest.alias("_rest")).select(
        id_col, F.regexp_extract("_rest", r"(?s)^([^/?#]*)", 1).alias("host"), F.regexp_extract("_rest", r"(?s)^[^/?#]*([^?#]*)", 1).alias("path")
    )
    split = split.select(id_col, ascii_lower(F.col("host")).alias("host"), "path")
    out = split.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")})
    schema = out.schema
    # longer hosts first: of equally long rules the one met first stays
    for n, block in enumerate(blocks(sorted(rules, key=lambda r: (-len(r[0]), r)), block_bytes)):
        swept = pages.sparkSession.sparkContext.broadcast(RuleSweep(block))

        def judge(batches: Iterator[pd.DataFrame], swept=swept) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rule, verdict = swept.value.sweep([reversed_key(h) for h in pdf["host"].tolist()], pdf["path"].tolist())
                for i, old in enumerate(pdf["rule"].tolist()):
                    if old is not None and (rule[i] is None or len(old) >= len(rule[i])):
                        rule[i], verdict[i] = old, pdf["verdict"].iat[i]
                yield pdf.assign(rule=pd.Series(rule, index=pdf.index, dtype=object), verdict=pd.Series(verdict, index=pdf.index, dtype=object))

        out = (durable(out) if n else out).mapInPandas(judge, schema)
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
