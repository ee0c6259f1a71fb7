"""Many phrases in one pass: a trie written as one pattern, used as a projection.

At every place of a text the pattern finds the longest phrase that begins
there.  Phrases share their prefixes, so the work at a place follows the text's
own letters and not the number of phrases, and no join is needed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def trie_pattern(phrases: list[str]) -> str:
    """A pattern for the longest of ``phrases`` at a place (not empty ones)."""
    root: dict = {}
    for p in phrases:
        node = root
        for c in p:
            node = node.setdefault(c, {})
        node[""] = {}

    def write(node: dict) -> str:
        """What follows a prefix: its only way on in a row, several ways as alternatives, optional where it may end."""
        ways = []
        for c in sorted(k for k in node if k):
            run, below = c, node[c]
            while len(below) == 1 and "" not in below:
                (c, below), = below.items()
                run += c
            ways.append("".join(re.escape(x) if x.isascii() and not x.isalnum() else x for x in run) + write(below))
        if not ways:
            return ""
        body = ways[0] if len(ways) == 1 and "" not in node else f"(?:{'|'.join(ways)})"
        return f"{body}?" if "" in node else body

    return write(root)


def found(text: Column, phrases: list[str]) -> Column:
    """Array of the distinct phrases that ``text`` contains, overlapping ones too, in no set order."""
    known = sorted({p for p in phrases if p})
    if not known:
        return F.array().cast("array<string>")
    longest = F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?=({trie_pattern(known)}))"), 1))
    # a phrase that begins another one is found with it; those that begin inside it have a place of their own
    held = set(known)
    also = {p: [p[:i] for i in range(1, len(p)) if p[:i] in held] for p in known}
    nested = {p: a for p, a in also.items() if a}
    if not nested:
        return longest
    more = F.create_map(*[x for p, a in nested.items() for x in (F.lit(p), F.array(*map(F.lit, a)))])
    rest = F.flatten(F.transform(longest, lambda p: F.coalesce(F.try_element_at(more, p), F.array().cast("array<string>"))))
    return F.array_distinct(F.concat(longest, rest))
