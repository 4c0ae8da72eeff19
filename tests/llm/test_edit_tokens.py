import random

import pytest

from isobar.llm import edit_tokens as et
from isobar.llm.tokens import byte_pairs, default_paths, encoder

BITS = [" ", "  ", "\n", "a", "the", " don", "'s", "1", "!", "é", " 日本", "\t", "<|endoftext|>", " x ", "word ", " ",
        "漢字かな交じり文", "ภาษาไทย", "'", "''ll", "\u0301", "½²", "\x1c", "\u3000", "한국어", "😀😀", "|>", "<|end", "oftext",
        "\r\n", "\u200b", "ⅷ", "\U00020000", "\u093c\u094d", "ﬁ", "\u2028", "ʼs", "-a", "a-", "1a", "a1"]
JOINS = byte_pairs(default_paths()[1])


def count(text):
    return len(encoder(*default_paths())(text))


@pytest.mark.parametrize("seed, leaf", [(0, 8), (1, 8), (2, 1), (3, 1), (4, 2), (5, 30)])
def test_random_edits_against_full_encoding(seed, leaf):
    r = random.Random(seed)
    for _ in range(120):
        text = "".join(r.choice(BITS) for _ in range(r.randint(0, 150)))
        parts = et.cut(text, JOINS, leaf)
        assert "".join(parts) == text
        tree = et.Tree.build([len(p) for p in parts], [count(p) for p in parts])
        assert tree.total == count(text)
        for _ in range(5):
            put = "".join(r.choice(BITS) for _ in range(r.randint(0, 8)))
            text, _ = tree.edit(text, r.randint(-2, len(text) + 2), r.randint(0, 30), put, count, JOINS, leaf)
            assert tree.total == count(text) and sum(tree.chars) == len(text)
            half = len(tree.sums) // 2
            assert tree.sums[half:half + len(tree.chars)] == [
                count(text[a:a + n]) for a, n in zip(starts(tree.chars), tree.chars)]
            assert all(tree.sums[i] == tree.sums[2 * i] + tree.sums[2 * i + 1] for i in range(1, half))


def starts(chars):
    at = 0
    for n in chars:
        yield at
        at += n


def test_only_the_neighbourhood_is_encoded_again():
    text = "word " * 20000
    parts = et.cut(text)
    tree = et.Tree.build([len(p) for p in parts], [count(p) for p in parts])
    text, work = tree.edit(text, 50000, 4, "edit", count)
    assert tree.total == count(text) and work < 4 * et.LEAF


@pytest.mark.parametrize("text", [
    "".join(chr(0x4e00 + i * 7919 % 20000) for i in range(100_000)),
    "".join(chr(0xe01 + i * 31 % 46) for i in range(120_000)),
    "".join(chr(0xac00 + i * 7919 % 11000) for i in range(50_000)),
    "word\n" * 40_000, "a1b2-" * 20_000, "x,y;" * 30_000, "\u0434\u0430-" * 30_000])
def test_texts_without_spaces_are_cut_too(text):
    parts = et.cut(text, JOINS)
    counts = [count(p) for p in parts]
    assert sum(counts) == count(text) and len(parts) > len(text) / et.LEAF / 3
    tree = et.Tree.build([len(p) for p in parts], counts)
    text, work = tree.edit(text, len(text) // 2, 4, "edit", count, JOINS)
    assert tree.total == count(text) and work < 12 * et.LEAF


def test_every_boundary_is_safe():
    """Cut at each place that counts as a boundary, the ids are those of the whole."""
    encode = encoder(*default_paths())
    r = random.Random(9)
    for _ in range(300):
        text = "".join(r.choice(BITS) for _ in range(12))
        whole = encode(text).tolist()
        for at in range(1, len(text)):
            if et.boundary(text[at - 1], text[at], JOINS):
                assert [*encode(text[:at]), *encode(text[at:])] == whole, (text, at)


def test_counts(spark, docs, edge, empty):
    for df in (docs, edge):
        rows = df.withColumn("edits", et.derived_edits()).select("doc_id", "text", "edits").collect()
        want = []
        for d in rows:
            t = d.text or ""
            for e in d.edits:
                t = t[:e["at"]] + e["put"] + t[e["at"] + e["drop"]:] if e["at"] <= len(t) else t + e["put"]
            want.append((d.doc_id, count(d.text or ""), count(t), len(t)))
        got = et.counts(df).collect()
        assert sorted((tuple(r[:4]) for r in got), key=str) == sorted(want, key=str)
    assert et.counts(empty).count() == 0


def test_edits_from_a_table(spark, edge):
    edits = spark.createDataFrame([(1, 2, 0, 3, "A"), (1, 1, 4, 3, "dog"), (3, 1, 9, 9, "new text"), (99, 1, 0, 0, "x"),
                                   (2, 1, None, None, None)], "doc_id long, seq int, at int, drop int, put string")
    got = et.apply_edits(et.attach_edits(et.index(edge), edits))
    rows = {r.doc_id: r for r in got.filter("doc_id < 4").collect()}
    assert rows[1].text == "A dog sat on the mat" and rows[1].edited_tokens == count(rows[1].text)
    assert rows[3].text == "new text" and rows[3].n_tokens == 0
    assert rows[2].edited_tokens == rows[2].n_tokens
    assert got.count() == edge.count()
