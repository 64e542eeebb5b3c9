import random

from burnlens.llm import decontaminate as d

BENCH = "item_id long, text string, errors int, start int"


def distance_inside(item, text):
    column = list(range(len(item) + 1))
    best = column[-1]
    for c in text:
        new = [0] * len(column)
        for i in range(1, len(column)):
            new[i] = min(column[i] + 1, new[i - 1] + 1, column[i - 1] + (item[i - 1] != c))
        column = new
        best = min(best, column[-1])
    return best


def edited(text, n, rnd):
    out = list(text)
    for _ in range(n):
        k = rnd.randrange(len(out))
        kind = rnd.random()
        if kind < 0.4:
            out[k] = rnd.choice("abcxyz ")
        elif kind < 0.7:
            del out[k]
        else:
            out.insert(k, rnd.choice("abcxyz"))
    return "".join(out)


def test_matches_are_those_within_the_budget(table):
    items = [(r.item_id, r.text) for r in table("benchmark").collect()]
    texts = [r.text for r in table("documents").limit(40).collect()]
    matcher, rnd = d.Matcher(items, 10), random.Random(3)
    for _ in range(60):
        number = rnd.randrange(len(items))
        item = d.normal(items[number][1])
        passage = edited(item, rnd.randint(0, len(item) // 10 + 3), rnd)
        raw = rnd.choice(texts)[:200] + "\n  " + passage.replace(" ", "  \n", 3) + "\t " + rnd.choice(texts)[:80]
        want = distance_inside(item, d.normal(raw))
        found = matcher.matches(raw)
        assert (number in found) == (want <= len(item) // 10)
        if number in found:
            errors, start, end = found[number]
            assert errors == want
            a, b = d.original_span(raw, start, end)
            assert d.normal(raw[a:b]) == d.normal(raw)[start:end].strip()


def test_whole_table_against_brute_force(table):
    """Exact passages by search; no other document is reported beyond its budget."""
    docs, items = table("documents"), {r.item_id: d.normal(r.text) for r in table("benchmark").collect()}
    texts = {r.doc_id: d.normal(r.text) for r in docs.collect()}
    got = {(r.doc_id, r.item_id): r.errors for r in d.query(docs, table("benchmark")).collect()}
    exact = {(i, k) for i, t in texts.items() for k, item in items.items() if item in t}
    assert exact == {pair for pair, errors in got.items() if errors == 0}
    for (i, k), errors in got.items():
        assert distance_inside(items[k], texts[i]) == errors <= len(items[k]) // 10


def test_blocks_give_the_same(table):
    docs, bench = table("documents"), table("benchmark")
    one = sorted(map(tuple, d.find(docs, bench).collect()))
    many = sorted(map(tuple, d.find(docs, bench, block_chars=2000).collect()))
    assert one == many and one
    kept = d.drop_contaminated(docs, bench, block_chars=2000)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - {r[0] for r in one}


def test_edge_cases(spark, edge_docs, edge_rows, empty_docs):
    same = edge_rows[4][1]
    bench = spark.createDataFrame([(1, None, 1, 1), (2, "", 1, 1), (3, same, 1, 1), (3, same, 1, 1), (None, edge_rows[0][1], 1, 1), (4, "one two", 1, 1)], BENCH)
    got = sorted(map(str, d.find(edge_docs, bench).select("doc_id", "item_id", "errors").collect()))
    want = [(5, 3)] * 4 + [(1, None), (9, None), (11, 4)]
    assert got == sorted(f"Row(doc_id={i}, item_id={k}, errors=0)" for i, k in want)
    assert sorted(str(r.doc_id) for r in d.drop_contaminated(edge_docs, bench).collect()) == sorted(map(str, [2, 3, 4, None, 7, 8, 10]))
    assert d.find(empty_docs, bench).count() == 0
    assert d.find(edge_docs, bench.where("false")).count() == 0
    assert d.drop_contaminated(edge_docs, bench.where("false")).count() == len(edge_rows)


def test_a_hot_piece_stays_linear():
    items = [(1, "the the the the cat sat on the the mat the the the the")]
    matcher = d.Matcher(items, 10)
    assert not matcher.matches("the " * 20_000)
    assert matcher.matches("the " * 20_000 + items[0][1])[0][0] == 0


def test_items_of_one_template_share_their_checks(monkeypatch):
    """A node of equal text, and a window of equal text, is verified once for all items and hits."""
    head = "the committee met again on the first monday of the month and "
    items = [(k, f"{head}agreed upon the plan number {k:04d} for the harbour of the northern town") for k in range(400)]
    checks = []
    best = d.Pattern.best
    monkeypatch.setattr(d.Pattern, "best", lambda self, window: checks.append(self.size) or best(self, window))
    matcher = d.Matcher(items, 10)
    words = ["grain", "copper", "timber", "salt"]
    text = " ".join(f"{head}spoke of {words[k % 4]} only." for k in range(50))
    assert not matcher.matches(text)
    # Whole items are checked once for each of the few windows that differ, not for 400 items x 50 passages x pieces.
    assert len(checks) < 400 * 10
    monkeypatch.setattr(d, "REMEMBERED", 0)  # nothing is kept: the same result
    assert not d.Matcher(items[:20], 10).matches(text)
    found = matcher.matches(f"{text} {items[7][1]}")
    assert found[7][0] == 0
    assert all((number in found) == (distance_inside(matcher.items[number][1], items[7][1]) <= 13) for number in (0, 7, 8, 123, 399))


def test_equal_items_are_found_alike_in_any_company():
    rnd = random.Random(8)
    base = "a quiet river runs below the old mill and nobody in the village remembers its name "
    items = [(k, edited(base, k % 5, rnd)) for k in range(12)] + [(99, base), (100, base)]
    text = "x " * 30 + " ".join(edited(base, k % 7, rnd) for k in range(9)) + " y" * 20
    together = d.Matcher(items, 10).matches(text)
    for number, item in enumerate(items):
        alone = d.Matcher([item], 10).matches(text)
        assert alone.get(0) == together.get(number)
    assert together[12] == together[13]
