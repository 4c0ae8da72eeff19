"""Edit-aware token counts (operator 9).

Each document keeps a segment tree: leaves are runs of whole pre-tokens with
their token counts, inner nodes are sums. An edit re-encodes only the leaves
it touches, and a neighbour when the edit comes so near the boundary between
them that the pre-tokens there may change; sums are updated on the path to
the root.

A boundary stands where the tokenizer never joins the two sides, whatever
surrounds them, as told by the two characters at it:

* before white space that follows anything else: pre-tokens have white space at
  their start only, so a single space and a line end alike;
* where letters, digits and other signs meet, but behind an apostrophe, which
  may begin a contraction;
* inside such a run, where no token of the vocabulary has the last byte of the
  one character before the first byte of the other: no merge can cross it.
  Scripts that do without spaces are cut here; an apostrophe is not cut off.

So counts of leaves add up to the count of the text.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import small_batches
from isobar.llm.tokens import SPECIAL, byte_pairs, default_paths, encoder

LEAF = 256  # characters of a leaf, about


# Characters that the pre-token pattern takes as white space.
WHITE = set("\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") | {chr(c) for c in range(0x2000, 0x200b)}
OLD = unicodedata.ucd_3_2_0


@lru_cache(maxsize=1 << 16)
def kind(c: str) -> str:
    """``w`` for white space, ``L`` letter, ``N`` number, ``o`` any other sign; empty where versions of
    Unicode might not agree."""
    if c in WHITE:
        return "w"
    now = unicodedata.category(c)
    if now != OLD.category(c) or now in ("Cn", "Cc", "Cs"):
        return ""
    return now[0] if now[0] in "LN" else "o"


def boundary(a: str, b: str, joins: frozenset) -> bool:
    """Whether the text may be cut between the characters ``a`` and ``b``; ``joins`` are the pairs of bytes
    that follow one another in a token."""
    x, y = kind(a), kind(b)
    if not x or not y or x == "w" or a == "'" or a + b in SPECIAL:
        return False
    return x != y or b != "'" and (a.encode()[-1], b.encode()[0]) not in joins


def cut(text: str, joins: frozenset = frozenset(product(range(256), repeat=2)), leaf: int = LEAF) -> list[str]:
    """The text in runs of whole pre-tokens, or parts that no merge crosses, ``leaf`` characters or
    a little more each. Without ``joins`` only whole pre-tokens."""
    out, start = [], 0
    while True:
        at = start + leaf
        while at < len(text) and not boundary(text[at - 1], text[at], joins):
            at += 1
        if at >= len(text):
            return [*out, text[start:]]
        out.append(text[start:at])
        start = at


class Tree:
    """Leaf lengths and a heap of sums: ``sums[1]`` is the document's count, and the leaf ``i``
    is ``sums[len(sums) // 2 + i]``."""

    def __init__(self, chars: list[int], sums: list[int]):
        self.chars, self.sums = list(chars), list(sums)

    @staticmethod
    def build(chars: list[int], counts: list[int]) -> Tree:
        width = 1
        while width < len(counts):
            width *= 2
        sums = [0] * width + list(counts) + [0] * (width - len(counts))
        for i in range(width - 1, 0, -1):
            sums[i] = sums[2 * i] + sums[2 * i + 1]
        return Tree(chars, sums)

    @property
    def total(self) -> int:
        return self.sums[1]

    def set(self, leaf: int, chars: int, count: int) -> None:
        self.chars[leaf] = chars
        i = len(self.sums) // 2 + leaf
        more = count - self.sums[i]
        while i:
            self.sums[i] += more
            i //= 2

    def edit(self, text: str, at: int, drop: int, put: str, count: Callable[[str], int],
             joins: frozenset = frozenset(product(range(256), repeat=2)), leaf: int = LEAF) -> tuple[str, int]:
        """Replace ``drop`` characters at ``at`` by ``put``. Returns the new text
        and how many characters were encoded again. Places outside the text
        are moved to its ends."""
        at = min(max(at, 0), len(text))
        drop = min(max(drop, 0), len(text) - at)
        starts = [0, *accumulate(self.chars)]  # and the end
        n = len(self.chars)
        lo = min(bisect_right(starts, at) - 1, n - 1)
        # a boundary holds while the characters on both sides of it stay
        while lo > 0 and at <= starts[lo] + 1:
            lo -= 1
        hi = min(max(bisect_right(starts, at + drop) - 1, lo), n - 1)
        while hi < n - 1 and starts[hi + 1] <= at + drop:
            hi += 1
        middle = text[starts[lo]:at] + put + text[at + drop:starts[hi + 1]]
        parts = cut(middle, joins, leaf)
        counts = [count(p) for p in parts]
        if len(parts) <= hi - lo + 1:  # the tree keeps its shape; leaves too many become empty
            for i in range(lo, hi + 1):
                k = i - lo
                self.set(i, len(parts[k]) if k < len(parts) else 0, counts[k] if k < len(parts) else 0)
        else:  # more leaves: sums are laid out anew, other leaves' counts stay
            half = len(self.sums) // 2
            old = self.sums[half:half + n]
            fresh = Tree.build(self.chars[:lo] + [len(p) for p in parts] + self.chars[hi + 1:],
                               old[:lo] + counts + old[hi + 1:])
            self.chars, self.sums = fresh.chars, fresh.sums
        return text[:at] + put + text[at + drop:], len(middle)


TREE = "leaf_chars array<int>, tree array<int>"
EDIT = "array<struct<at:int,drop:int,put:string>>"


def index(documents: DataFrame, leaf: int = LEAF, paths=None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``documents``' columns ``keep`` and ``text`` with each document's tree
    (``leaf_chars, tree``). NULL text is like an empty one."""
    small_batches(documents.sparkSession)
    paths = paths or default_paths()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, joins = encoder(*paths), byte_pairs(paths[1])
        for b in batches:
            trees = []
            for text in b["text"]:
                parts = cut(text or "", joins, leaf)
                trees.append(Tree.build([len(p) for p in parts], [len(encode(p)) for p in parts]))
            b["leaf_chars"], b["tree"] = [t.chars for t in trees], [t.sums for t in trees]
            yield b

    rows = documents.select(*keep, "text")
    types = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    return rows.mapInPandas(run, f"{types}, {TREE}")


def apply_edits(indexed: DataFrame, leaf: int = LEAF, paths=None) -> DataFrame:
    """Apply each row's ``edits`` (array of ``at, drop, put``, one after the other)
    to its text and tree. Adds ``n_tokens`` (before), ``edited_tokens`` and
    ``encoded_chars`` (encoded again); NULL edits change nothing, and a NULL
    text with edits starts empty."""
    small_batches(indexed.sparkSession)
    paths = paths or default_paths()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, joins = encoder(*paths), byte_pairs(paths[1])
        for b in batches:
            texts, chars, trees, before, after, work = [], [], [], [], [], []
            for text, lens, sums, edits in zip(b["text"], b["leaf_chars"], b["tree"], b["edits"]):
                tree, done = Tree([int(x) for x in lens], [int(x) for x in sums]), 0
                before.append(tree.total)
                for e in edits if edits is not None else ():
                    text, n = tree.edit(text or "", int(e["at"] or 0), int(e["drop"] or 0), e["put"] or "",
                                        lambda p: len(encode(p)), joins, leaf)
                    done += n
                texts.append(text)
                chars.append(tree.chars)
                trees.append(tree.sums)
                after.append(tree.total)
                work.append(done)
            yield b.drop(columns="edits").assign(text=texts, leaf_chars=chars, tree=trees, n_tokens=before,
                                                 edited_tokens=after, encoded_chars=work)

    types = ", ".join(f"`{n}` {t}" for n, t in indexed.dtypes if n != "edits")
    return indexed.mapInPandas(run, f"{types}, n_tokens bigint, edited_tokens bigint, encoded_chars bigint")


def attach_edits(indexed: DataFrame, edits: DataFrame) -> DataFrame:
    """Join edits ``(doc_id, seq, at, drop, put)`` to the index in ``seq`` order.
    An edit list per document must fit in memory, like the document."""
    lists = edits.groupBy(F.col("doc_id").alias("_id")).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("seq", "at", "drop", "put"))),
        lambda e: F.struct(e["at"].cast("int").alias("at"), e["drop"].cast("int").alias("drop"),
                           e["put"].alias("put"))).alias("edits"))
    return indexed.join(lists, F.col("doc_id").eqNullSafe(F.col("_id")), "left").drop("_id")


def derived_edits(n: int = 2) -> Column:
    """``n`` edits of each document that follow from its id, source and length."""
    length = F.coalesce(F.length("text"), F.lit(0))

    def edit(i):
        at = F.pmod(F.xxhash64("doc_id", F.lit(i)), length + 1).cast("int")
        drop = F.pmod(F.xxhash64("doc_id", F.lit(i), F.lit("drop")), F.lit(24)).cast("int")
        put = F.concat(F.lit(" revised by "), F.coalesce("source", F.lit("?")),
                       F.element_at(F.array(*map(F.lit, ["", " ", "\n\n", "'s", "42"])), F.lit(i % 5 + 1)))
        return F.struct(at.alias("at"), drop.alias("drop"), put.alias("put"))

    return F.array(*[edit(i) for i in range(n)])


def counts(documents: DataFrame, n_edits: int = 2, leaf: int = LEAF, paths=None) -> DataFrame:
    """``doc_id, n_tokens, edited_tokens, edited_chars, encoded_chars, n_leaves`` of
    every document before and after its derived edits."""
    rows = documents.withColumn("edits", derived_edits(n_edits))
    trees = index(rows, leaf, paths, keep=("doc_id", "edits"))
    done = apply_edits(trees, leaf, paths)
    return done.select("doc_id", "n_tokens", "edited_tokens",
                       F.length("text").cast("bigint").alias("edited_chars"), "encoded_chars",
                       F.size("leaf_chars").cast("bigint").alias("n_leaves"))
