"""Plain versions that operators are compared with."""

import math

import numpy as np

from courtside.llm import decontaminate


def best_overlap(text, item, min_words=13, share=0.8):
    """(matches, first word, one past the last) over all alignments, compared word by word."""
    need = min(min_words, max(1, math.ceil(share * len(item) - 1e-9)))
    found = []
    for shift in range(-len(item) + 1, len(text)):
        a, b = max(0, shift), min(len(text), shift + len(item))
        same = [text[k] == item[k - shift] for k in range(a, b)]
        if len(item) < decontaminate.LONG:
            at = [k for k, x in enumerate(same) if x]
            start, end = (at[0], at[-1] + 1) if at else (0, 0)
        else:
            sums = np.concatenate(([0], np.cumsum([1 if x else -2 for x in same])))
            end = max(range(1, len(sums)), key=lambda e: sums[e] - min(sums[:e]))
            start = int(np.argmin(sums[:end]))
        if sum(same[start:end]) >= need:
            found.append((-sum(same[start:end]), a + start, a + end))
    return (-min(found)[0], *min(found)[1:]) if found else None
