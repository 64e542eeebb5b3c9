import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from burnlens.llm import decontaminate, pii, simhash, toxicity

SF = "/root/testdata/sf0.001"


def plain_pipeline(docs, items, toxic, field):
    """What is left, by plain Python over one stage after the other; the two learned models are given."""
    docs = [d for d in docs if d[0] not in toxic]
    prints = [simhash.fingerprint((t or "").encode()) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    best = {}
    for k, (i, _) in enumerate(docs):
        best[find(k)] = min(best.get(find(k), 1 << 60), i)
    docs = [d for d in docs if d[0] in best.values()]
    matcher = decontaminate.Matcher(items, decontaminate.CHARS_PER_ERROR)
    docs = [d for d in docs if not any(decontaminate.Pattern(item).best(decontaminate.normal(d[1] or ""))[0] <= len(item) // 10 for _, item in matcher.items)]
    out = {}
    for i, t in docs:
        t = t or ""
        base = pii.base_spans(t)
        out[i] = pii.redacted(t, base + pii.added_spans(t, base, field))
    return out


def test_stages_against_brute_force(spark, table):
    docs = table("documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash", "decontamination", "pii", "packing"]
    model = toxicity.train(docs, table("labels"), toxicity.not_held_out())
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    toxic = {i for (i, _), p in zip(rows, model.scores([t or "" for _, t in rows])) if p >= toxicity.THRESHOLD}
    assert toxic
    left = docs
    for name in ("toxicity", "simhash", "decontamination"):
        left = stages[name](spark, left, SF)
        assert left.columns == docs.columns
    field = pii.train(left)
    redacted = stages["pii"](spark, left, SF)
    assert redacted.columns == docs.columns
    items = [(r.item_id, r.text) for r in table("benchmark").collect()]
    want = plain_pipeline(rows, items, toxic, field)
    assert {r.doc_id: r.text for r in redacted.collect()} == want
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    assert set(pieces) == set(want)
    for i, parts in pieces.items():
        ids = np.array([*plain.encode(want[i], add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for start, length, crc in sorted(parts):
            assert start == at and zlib.crc32(ids[at : at + length].tobytes()) == crc
            at += length
        assert at == len(ids)


def test_stages_take_edge_cases(spark, edge_docs, empty_docs):
    for docs in (edge_docs, empty_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()


def test_entry_registers_all():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))
    assert {"op4_topk", "op5_warc"} <= set(entry.oracle_sql())
