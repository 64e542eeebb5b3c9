import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from burnlens.llm import contexts, lm, mixing, quality, toxicity
from burnlens.llm.labelled import held_out


def plain_base(rows):
    counts, n = Counter(), 0
    out = [zlib.crc32(str(i).encode()) % 10 == 0 if i is not None else False for i, _ in rows]
    for (_, t), held in zip(rows, out):
        if not held:
            counts.update((t or "").encode().lower().split())
            n += 1
    total, types = sum(counts.values()) + n, len(counts) + (n > 0)
    each = np.log10(total + 0.1 * (types + 1))
    result = []
    for (i, t), held in zip(rows, out):
        words = (t or "").encode().lower().split()
        score = sum(np.log10(counts[w] + 0.1) for w in words) + np.log10(n + 0.1) - (len(words) + 1) * each
        result.append((i, held, len(words) + 1, sum(counts[w] > 0 for w in words) + (n > 0), total, float(score)))
    return result


def assert_base(got, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 3))
    for a, b in zip(sorted((tuple(r)[:6] for r in got), key=key), sorted(plain_base(rows), key=key), strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) <= 1e-8 * max(1, abs(b[5]))


def test_lm_whole_table(table, monkeypatch):
    rows = [(r.doc_id, r.text) for r in table("documents").collect()]
    got = lm.query(table("documents").repartition(3)).collect()
    assert_base(got, rows)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 1.1  # white space is scored, too
    size = sum(len((t or "").encode()) + 1 for _, t in rows)
    assert -sum(r.score for r in got) / np.log10(2) / size < 3.2  # bits per byte
    # With hardly any head, the join gives the same sums.
    monkeypatch.setattr(lm, "HEAD_WORDS", 40)
    assert_base(lm.query(table("documents")).collect(), rows)


def test_lm_edge_cases(edge_docs, edge_rows, empty_docs):
    got = lm.query(edge_docs).collect()
    assert_base(got, [(r[0], r[1]) for r in edge_rows])
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert lm.query(empty_docs).count() == 0
    only = edge_docs.where(F.col("doc_id") == 10)
    assert lm.query(only.where(held_out(F.col("doc_id"), 10, 0))).count() in (0, 1)


def plain_events(model, text):
    stream = mixing.START + bytes(mixing.LOWER[np.frombuffer(text, np.uint8)]) + mixing.END
    kind = int(mixing.classes(np.frombuffer(stream, np.uint8), np.array([5]))[0])
    start, window, word = 5, [], []
    for k in range(5, len(stream)):
        before = stream[k - 5 : k] if k == start else (b"\0\0\0\0 " + stream[start:k])[-5:]
        window.append(int.from_bytes(before + stream[k : k + 1], "big") | kind << 48)
        own = np.frombuffer(stream[start:k], np.uint8)
        word.append(int(mixing.stretch_hash(mixing.prefix_sums(own), np.array([0]), np.array([len(own)]))[0]))
        if stream[k] in b" \t\n\r\x0b\x0c":
            start = k + 1
    return np.array(window, np.uint64), np.array(word, np.uint64)


def plain_contexts(window, word):
    for order in range(mixing.ORDERS):
        kind = window >> 48 if order in mixing.CLASS_ORDERS else 0
        yield order, kind, word if order == mixing.ORDERS - 1 else window >> 8 & (1 << 8 * (order + 1)) - 1


def plain_log2(seen, mixer, window, word):
    """log2 probability of one byte: its bits one after the other, each mixed from six contexts and refined."""
    total = 0.0
    for k in range(8):
        bit = window >> (7 - k) & 1
        before, x = (window & 255) >> (8 - k), []
        for context in plain_contexts(window, word):
            n0, n1 = seen[context, k + 1, 2 * before], seen[context, k + 1, 2 * before + 1]
            x.append(0.0 if n0 + n1 == 0 else float(np.log((n1 + mixing.PRIOR) / (n0 + mixing.PRIOR))) or 1e-4)
        gate = (k * mixing.ORDERS + sum(v != 0 for v in x[:-1])) * 2 + (x[-1] != 0)
        mix = sum(w * v for w, v in zip(mixer.weights[gate], x))
        at = min(max(mix / mixing.LEVEL_STEP + mixing.LEVELS // 2, 0), mixing.LEVELS - 1.001)
        low = int(at)
        rate = mixer.ones[k] / mixer.hits[k]
        p = (1 / (1 + np.exp(-mix)) + rate[low] * (1 - at + low) + rate[low + 1] * (at - low)) / 2
        p = min(max(p, 1e-6), 1 - 1e-6)
        total += np.log2(p if bit else 1 - p)
    return total


def test_scores_are_those_of_a_plain_coder(spark, monkeypatch):
    """Every text of the query, byte by byte and bit by bit from plain counts of all training bytes."""
    rnd = random.Random(2)
    words = ["the", "of", "stone", "Stones", "überall", "lo", "!!", "x" * 70, "y" * 300]
    texts = [" ".join(rnd.choice(words) + rnd.choice(["", "", "s"]) for _ in range(rnd.randint(0, 50))) for _ in range(50)] + ["", " ", "\n\n a  b", "\0\0", None, "unseen words"]
    mixers, train = [], contexts.train_mixer
    monkeypatch.setattr(contexts, "train_mixer", lambda full: mixers.append(train(full)) or mixers[-1])
    got = {r.doc_id: r for r in lm.query(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    seen, events = Counter(), [list(zip(*(a.tolist() for a in plain_events(None, (t or "").encode())))) for t in texts]
    for k, some in enumerate(events):
        if not got[k].held_out:
            for window, word in some:
                for context in plain_contexts(window, word):
                    for j in range(1, 9):
                        seen[context, j, (window & 255) >> (8 - j)] += 1
    assert any(r.held_out for r in got.values()) and len(got) == len(texts)
    for k, some in enumerate(events):
        want = sum(plain_log2(seen, mixers[0], window, word) for window, word in some) - np.log2(mixing.CLASSES)
        assert abs(got[k].score - want * np.log10(2)) < 1e-4 * max(1, abs(want))
        assert abs(got[k].bits_per_byte + want / len(some)) < 1e-4 * max(1, abs(want))


def test_toxicity_finds_held_out_rows(table, spark):
    docs, labels = table("documents"), table("labels")
    rows = toxicity.query(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    known = [r for r in rows if r.doc_id in truth]
    assert sum(r.predicted for r in known if not truth[r.doc_id]) == 0


def test_toxicity_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in toxicity.query(docs, labels).collect() if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right / len(held) > 0.93


def test_label_model_recovers_rates_and_dependence():
    rng = np.random.default_rng(3)
    n = 40_000
    y = rng.random(n) < 0.15
    a = np.where(y, rng.random(n) < 0.8, rng.random(n) < 0.03)
    b = np.where(y, rng.random(n) < 0.6, rng.random(n) < 0.05)
    c = np.where(y, rng.random(n) < 0.7, rng.random(n) < 0.02)
    copy = np.where(rng.random(n) < 0.9, a, ~a)  # depends on a given the class
    noise = rng.random(n) < 0.3
    patterns, weight = np.unique(np.stack([a, b, c, copy, noise], 1), axis=0, return_counts=True)
    model = toxicity.fit_label_model(patterns, weight.astype(float))
    assert abs(model.prior - 0.15) < 0.03
    assert 0 in (model.parent[3],) or model.parent[0] == 3
    p = model.posterior(np.stack([a, b, c, copy, noise], 1))
    # Nearly as good as Bayes' rule with the true rates (the copy and the noise add nothing).
    odds = np.log(0.15 / 0.85)
    for v, on, off in ((a, 0.8, 0.03), (b, 0.6, 0.05), (c, 0.7, 0.02)):
        odds = odds + np.where(v, np.log(on / off), np.log((1 - on) / (1 - off)))
    assert ((p > 0.5) == y).mean() > ((odds > 0) == y).mean() - 0.025


def test_toxicity_edge_cases(edge_docs, edge_rows, edge_labels, empty_docs, table):
    for labels in (edge_labels, edge_labels.where("false")):
        rows = toxicity.query(edge_docs, labels).collect()
        assert len(rows) == len(edge_rows) and all(0 <= r.score <= 1 for r in rows)
        assert toxicity.query(empty_docs, labels).count() == 0
    model = toxicity.train(table("documents"), table("labels"), toxicity.not_held_out())
    kept = toxicity.drop_toxic(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.count() == len(edge_rows)
    assert toxicity.drop_toxic(empty_docs, model).count() == 0


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality.query(docs, labels).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_quality_edge_cases(edge_docs, edge_rows, edge_labels, empty_docs):
    for labels in (edge_labels, edge_labels.where("false")):
        rows = quality.query(edge_docs, labels).collect()
        assert len(rows) == len(edge_rows) and all(0 <= r.score <= 1 for r in rows)
        assert quality.query(empty_docs, labels).count() == 0
    assert {r.score for r in quality.query(edge_docs, edge_labels.where("false")).collect()} == {0.5}


def test_statistics_by_hand():
    x = dict(zip(quality.FEATURES, quality.statistics([b"Ab ab AB\nx1 ab ab!", b""])[0]))
    n = 18
    assert np.isclose(x["upper"], 3 / n) and np.isclose(x["digit"], 1 / n) and np.isclose(x["other_mark"], 1 / n)
    assert np.isclose(x["words_upper"], 1 / 6) and np.isclose(x["words_marked"], 1 / 6)
    assert np.isclose(x["distinct_words"], 5 / 6) and np.isclose(x["top_word"], 2 / 6)
    assert np.isclose(x["log_lines"], np.log1p(2))
    assert not quality.statistics([b"", b"a"])[0].any()


def test_trees_agree_with_a_plain_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 25))
    y = ((x[:, 3] > 0) ^ (x[:, 7] > 0.5)).astype(float)
    forest = quality.fit(x, y, trees=20, depth=3)
    margin = []
    for row in x:
        total = forest.base
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + (row[feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        margin.append(total)
    assert np.allclose(forest.margin(x), margin)
    assert ((forest.score(x) > 0.5) == y).mean() > 0.95
