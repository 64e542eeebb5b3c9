import hashlib
import random
import re
from collections import Counter

from burnlens.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), m.end(), 0) for m in EMAIL.finditer(t)]
    out += [(m.start(), m.end(), 1) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(t):
        d = digits(m)
        twice = [int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(d[::-1])]
        if 14 <= len(d) <= 19 and sum(twice) % 10 == 0:
            out.append((m.start(), m.end(), 2))
    out += [(m.start(), m.end(), 3) for m in PHONE.finditer(t) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rnd = random.Random(0)
    alphabets = ["01234567899", "@.a-", "+ ()-.", "abc é٣", "255.", "@x.y", "4111111111111111"]
    whole = ["a@b.c", "1.2.3.4", "+1 555 123 4567", "4111 1111 1111 1111", "000.1.2.3"]
    for _ in range(20_000):
        t = "".join(rnd.choice(rnd.choice(alphabets)) if rnd.random() < 0.9 else rnd.choice(whole) for _ in range(rnd.randint(0, 40)))
        assert pii.base_spans(t) == plain_spans(t), t


def test_long_runs_take_linear_time():
    for t in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + " " * 100_000, "(" * 100_000 + "[at]", "a." * 100_000 + "[at]", "0" * 5000 + ".1.1.1"):
        base = pii.base_spans(t)
        pii.candidates(t, base)


def trained(texts):
    total = Counter()
    for t in texts:
        total.update(pii.factor_counts(t))
    return pii.Field.of(total)


def test_field_adds_other_forms_of_known_mentions(table):
    model = trained([r.text for r in table("documents").collect()])

    def added(t):
        base = pii.base_spans(t)
        return [(t[s:e], pii.KINDS[k]) for s, e, k in pii.added_spans(t, base, model)]

    assert added("Mail jane.doe@corp.org, later jane.doe [at] corp [dot] org") == [("jane.doe [at] corp [dot] org", "email")]
    assert added("Call +1 (974) 555-3436 now. Or 974-555-3436, or (974) 555 3436.") == [("974-555-3436", "phone"), ("(974) 555 3436", "phone")]
    assert added("card 4111 1111 1111 1111 then 4111.1111.1111.1111") == [("4111.1111.1111.1111", "card")]
    assert added("host 10.1.2.3 then 10[.]1[.]2[.]3") == [("10[.]1[.]2[.]3", "ip")]
    # Without a known mention a bare number is nobody's, and plain words are no address.
    assert added("order 974-555-3436 of 123456789012") == []
    assert added("at noon dot com we met at house dot") == []


def test_messages_agree_with_enumeration():
    """On a tree, sum-product is exact."""
    import itertools

    import numpy as np

    model = trained(["a@b.co 10 4111111111111111 1234567 +15551234567 and 5551234567"] * 5)
    t = "+1 555 123 4567 " + " " * 60 + "555 123 4567"
    base = pii.base_spans(t)
    nodes = sorted([pii.base_node(t, s) for s in base] + pii.candidates(t, base), key=lambda n: n.start)
    unary = [model.unary(n) for n in nodes]
    total = np.zeros((len(nodes), pii.LABELS))
    for labels in itertools.product(range(pii.LABELS), repeat=len(nodes)):
        w = sum(u[y] for u, y in zip(unary, labels)) + sum(model.pairs[f][labels[i], labels[j]] for f, i, j in pii.links(nodes))
        for k, y in enumerate(labels):
            total[k, y] += np.exp(w)
    assert np.allclose(model.beliefs(nodes), total / total.sum(1, keepdims=True), atol=1e-6)


def test_query_keeps_base_spans(table):
    texts = {r.doc_id: r.text for r in table("documents").collect()}
    rows = pii.query(table("documents")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_spans(texts[r.doc_id])
        line = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, e, k in sorted(want, key=lambda x: (x[0], x[2])))
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(line.split(",")) - {""} <= set(r.spans.split(","))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == j for _, _, k in want) for j in range(4))


def test_edge_cases(spark, edge_docs, edge_rows, empty_docs):
    got = pii.find(edge_docs).collect()
    assert len(got) == len(edge_rows)
    assert {r.base_sha256 for r in got if r.doc_id in (2, 3, 7)} == {hashlib.sha256(b"").hexdigest()}
    assert pii.find(empty_docs).count() == 0
    out = pii.redact(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == len(edge_rows)
    assert pii.redact(empty_docs).count() == 0


def test_redact_replaces_all_spans(spark):
    docs = spark.createDataFrame([(1, "x a@b.co y 10.0.0.1", 19, "k"), (2, None, None, "k")], "doc_id long, text string, n_chars int, `kind` string")
    rows = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert rows[1].text == "x [EMAIL] y [IP]" and rows[1].n_chars == len(rows[1].text)
    assert rows[2].text is None and rows[2].n_chars is None
