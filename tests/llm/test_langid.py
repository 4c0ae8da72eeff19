import zlib

import numpy as np
import pytest

from isobar.llm import langid


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    net = langid.Network.new(["a", "b", "c"], 3, rng)
    net.e, net.u = ([w.astype(float) for w in x] for x in (net.e, net.u))
    net.v, net.c = net.v.astype(float), net.c.astype(float)
    seg, mask = langid.as_matrix([b"hello world", b"x" * langid.SEGMENT, b"abc", b""])
    lang = np.array([0, 1, 2, 0])
    _, grads = net.gradients(seg, mask, lang)
    for w, g in zip(net.weights(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, e = w[at], 1e-3
        w[at] = old + e
        up, _ = net.gradients(seg, mask, lang)
        w[at] = old - e
        down, _ = net.gradients(seg, mask, lang)
        w[at] = old
        assert (up - down) / (2 * e) == pytest.approx(g[at], rel=2e-3, abs=1e-5)


def test_pooling_reads_every_byte_once():
    net = langid.Network.new(["a", "b"], 4, np.random.default_rng(1))
    texts = ["short", "x" * 64, "y" * 65, "é" * 700, ""]
    got = langid.probabilities(net, texts)
    for t, p in zip(texts, got):
        raw = t.encode()
        if not raw:
            continue
        seg, mask = langid.as_matrix([raw[i:i + langid.SEGMENT] for i in range(0, len(raw), langid.SEGMENT)])
        pos = net.positions(seg).transpose(1, 0, 2)
        assert p == pytest.approx(pos[mask].mean(0), rel=1e-4)
        assert pos[mask].shape[0] == len(raw)


def test_held_out_accuracy(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 400)
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.report(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == documents.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    test = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in test) >= 0.97 * len(test)
    kept = langid.identified(documents)
    assert kept.columns == documents.columns and kept.count() >= 0.99 * documents.count()


def test_only_rows_not_held_out_are_learned(docs):
    segs, langs = langid.sample(docs, docs=10, segments=2)
    texts = {r.doc_id: r for r in docs.collect()}
    learn = [r for d, r in texts.items() if zlib.crc32(str(d).encode()) % 4 != 2]
    assert 0 < len(segs) <= 2 * 10 * len(set(langs))
    for s, lang in zip(segs, langs):
        assert len(s) <= langid.SEGMENT and any(s in r.text.encode() and r.lang == lang for r in learn)


def test_edge_cases(edge, empty, docs, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 5)
    net = langid.train(*langid.sample(docs, 20, 1), steps=5)
    got = langid.predict(edge.select("doc_id", "text", "lang"), net).collect()
    assert len(got) == edge.count()
    by = {(r.doc_id, r.lang): r for r in got}
    for key in ((3, "en"), (4, None), (5, "de"), (9, "fr"), (None, None)):
        assert by[key].lang_pred == "und" and by[key].score == 0
    assert by[1, "en"].lang_pred in net.langs and by[8, "de"].lang_pred in net.langs
    assert langid.report(empty).count() == 0 and langid.identified(empty).count() == 0
    assert {r.lang_pred for r in langid.predict(edge.select("doc_id", "text"), None).collect()} == {"und"}
