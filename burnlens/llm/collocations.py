"""Phrase collocations by Toivonen's sampling, per language.

1. A sample of the documents (one in ``SAMPLE_EVERY`` by hash) proposes the phrases
   of up to four words that reach a lowered count in it.
2. One full pass counts the proposed phrases and their negative border: phrases that
   were not proposed, but whose two phrases of one word less were.  There are very many
   of them, so they are counted under 64-bit hashes, dealt over as many parts as the
   text asks for; a hash can only overstate a count.
3. The last pass spells out, and counts as strings, what reached the minimum: proposed
   phrases that are confirmed, border failures (frequent though not proposed), and
   every longer phrase that holds a failure and has no part that is known to be rare.  A
   frequent phrase that the full pass left out holds a failure (its shortest part that
   was not proposed lies in the border), and this pass goes up to four words at once,
   so one expansion closes the border.

So every count in the result is of the phrase itself, over all documents.  What goes
to the tasks is a bitmap of hashes of at most ``MAX_BITS`` bits; where it fills up, more
phrases are counted than need be, and none is lost.  Tasks count by windows of words,
and Spark adds the partial counts up, so a phrase or a language that holds a third of
all words is a few rows a task.

Defined cases: a null or empty text has no words; a null ``lang`` counts as ``und``;
repeated rows and rows without an id count like any others; a word or a text of any
length is taken whole; ties go as the ranking says (score, count, bytes of the phrase);
an empty table gives no rows; columns besides ``doc_id``, ``text`` and ``lang`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burnlens.llm.common import documents, materialize, small_batches, texts, tidied

WORDS = 4
MIN_COUNT = 30
TOP = 2000
#: One document in so many proposes phrases, at this share of the count to expect.
SAMPLE_EVERY, LOWERED = 8, 0.6
#: A longer phrase with this share (percent) of its part's count absorbs it.
ABSORBED = 80
#: Bitmap bits for each phrase, and the limits of a bitmap's size.
BITS_EACH, MIN_BITS, MAX_BITS = 16, 1 << 20, 1 << 29
#: Words that are counted together, and distinct words that a task remembers.
WINDOW, VOCABULARY = 1 << 20, 1_000_000
#: Bytes of text that are split at a time.
SLICE = 1 << 22
#: First level of the ranking: so many parts a language.
PARTS = 256

BREAKS = b".,;:!?\n\x0b\x0c\r"
TO_STOP = bytes.maketrans(BREAKS, b"." * len(BREAKS))
#: Bytes of text for one part of the hashed counts, and entries of one row.
PART_BYTES, ROW_ENTRIES = 16 << 20, 2048
HASHED = "part int, h array<long>, c array<long>"
COUNTED = "lang string, phrase string, c long"
LEFT, RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of all but its last word and of its last word."""
    x = a * LEFT + (b ^ (b >> np.uint64(29))) * RIGHT
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Bitmap:
    """Which hashes may be in a set; no hash of the set is ever missed."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(64 * len(words) - 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h & self.mask
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap(hashes: DataFrame, n: int) -> Bitmap:
    """A bitmap of ``hashes(h)``; the driver only gets its words, at most ``MAX_BITS / 64``."""
    bits = MIN_BITS
    while bits < min(BITS_EACH * n, MAX_BITS):
        bits *= 2
    at = F.col("h").bitwiseAND(F.lit(bits - 1))
    words = hashes.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast(h & 63 AS int))").alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return Bitmap(out)


class Vocabulary(dict):
    """Word -> number for one language; 0 is the end of a piece."""

    def __init__(self, all_words: list[bytes], hashes: list[int], lang: bytes):
        super().__init__({b".": 0})
        self.all_words, self.hashes, self.seed = all_words, hashes, xxhash.xxh64_intdigest(lang)

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.all_words)
        self.all_words.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word, self.seed))
        return n


def numbers(text: bytes, vocabulary: Vocabulary) -> np.ndarray:
    """Word numbers of a text, a 0 wherever a piece ends."""
    out, at = [np.zeros(1, np.int64)], 0
    while at < len(text):
        end = len(text)
        if end - at > SLICE:
            # Cut at a space; a longer word stays whole.
            end = text.rfind(b" ", at, at + SLICE) + 1 or text.find(b" ", at + SLICE) + 1 or len(text)
        tokens = text[at:end].lower().translate(TO_STOP).replace(b".", b" . ").split()
        out.append(np.fromiter(map(vocabulary.__getitem__, tokens), np.int64, len(tokens)))
        at = end
    out.append(np.zeros(1, np.int64))
    return np.concatenate(out)


class Levels:
    """Phrases of one window, level by level: unique keys, their counts and hashes."""

    def __init__(self, ids: np.ndarray, starts: int, hashes: np.ndarray):
        self.ids, self.starts, self.hashes = ids, starts, hashes

    def first(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words of the window (without the piece ends), number of each start, hashes, counts."""
        words, at = np.unique(self.ids, return_inverse=True)
        counts = np.bincount(at[: self.starts], minlength=len(words))
        return words, at, self.hashes[words], counts

    def longer(self, at: np.ndarray, h: np.ndarray, allowed: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Phrases of ``size`` words that start where ``allowed``; ``at`` numbers the phrases of one
        word less by start.  Their two halves ``(shorter phrase, last word)``, numbers by start
        (-1: none), hashes and counts."""
        place = np.flatnonzero(allowed)
        key = (at[place] << 32) | self.ids[place + size - 1]
        unique, back = np.unique(key, return_inverse=True)
        numbers = np.full(len(self.ids), -1, np.int64)
        numbers[place] = back
        left, last = unique >> 32, unique & 0xFFFFFFFF
        counts = np.bincount(back[place < self.starts], minlength=len(unique))
        return left, last, numbers, joined(h[left], self.hashes[last]), counts


def both(mask: np.ndarray) -> np.ndarray:
    """Where a phrase and the one a word later are both marked."""
    return mask & np.append(mask[1:], False)


def marked(numbers: np.ndarray, mask: np.ndarray) -> np.ndarray:
    out = np.zeros(len(numbers), bool)
    live = numbers >= 0
    out[live] = mask[numbers[live]]
    return out


def window_counts(ids: np.ndarray, starts: int, hashes: np.ndarray, mode: str, proposed: Bitmap | None, reached: Bitmap | None) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """For each length: the phrases' words, their hashes and counts (0: not counted).

    ``mode`` is ``short`` (all phrases of one or two words), ``long`` (longer ones whose
    shorter ones are all proposed or, past three words, possible), ``full`` (proposed
    ones and the negative border) or ``spell`` (those that reached the minimum, and
    longer ones that hold a border failure).
    """
    levels = Levels(ids, starts, hashes)
    words, at, h, counts = levels.first()
    spelled = [words]
    real = words > 0
    inside = real & (proposed.has(h) if proposed else True)
    possible = real & reached.has(h) if reached else inside
    if mode != "long":
        yield spelled, h, counts * (possible if mode == "spell" else real)
    m_in, m_possible = inside[at], possible[at]
    for size in range(2, WORDS + 1):
        if mode == "short" and size > 2:
            return
        # The full pass counts a phrase if both its shorter ones were proposed.
        counted = both(m_in)
        left, last, at, h, counts = levels.longer(at, h, both(m_possible) if mode == "spell" else counted, size)
        if not len(left):
            return
        spelled = [s[left] for s in spelled] + [last]
        inside = proposed.has(h) if proposed and not (mode == "long" and size > 2) else np.ones(len(left), bool)
        possible = inside
        if mode == "spell":
            done = np.zeros(len(left), bool)
            done[at[counted & (at >= 0)]] = True
            inside &= done
            possible = ~done | reached.has(h)
        if mode != "long" or size > 2:
            yield spelled, h, counts * possible if mode == "spell" else counts
        m_in, m_possible = marked(at, inside), marked(at, possible)


def by_part(h: np.ndarray, c: np.ndarray, parts: int) -> pa.RecordBatch:
    """Rows of at most ``ROW_ENTRIES`` hashes and counts, each of one part."""
    part = ((h >> np.uint64(34)) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, h, c = part[order], h[order], c[order]
    first = np.searchsorted(part, part)
    new = np.flatnonzero((np.arange(len(part)) - first) % ROW_ENTRIES == 0)
    ends = pa.array(np.append(new, len(part)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(part[new]), pa.ListArray.from_arrays(ends, pa.array(h.view(np.int64))), pa.ListArray.from_arrays(ends, pa.array(c))], names=["part", "h", "c"]
    )


def windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[bytes, np.ndarray, int, np.ndarray, list[bytes]]]:
    """``(lang, word numbers, starts, hashes of the words, words)``: the text of each language
    in windows, with the few words after each in which its last phrases end."""
    words: list[bytes] = [b"."]
    hashes: list[int] = [0]
    by_lang: dict[bytes, Vocabulary] = {}
    held: dict[bytes, list[np.ndarray]] = {}
    size: dict[bytes, int] = {}

    def cut(lang: bytes) -> Iterator[tuple[bytes, np.ndarray, int, np.ndarray, list[bytes]]]:
        ids, table = np.concatenate(held.pop(lang)), np.array(hashes, np.uint64)
        size.pop(lang)
        for k in range(0, len(ids), window):
            part = np.append(ids[k : k + window + WORDS - 1], np.zeros(WORDS, np.int64))
            yield lang, part, min(window, len(ids) - k), table, words

    for batch in batches:
        for lang, text in zip(texts(batch.column("lang")), texts(batch.column("text"))):
            if lang not in by_lang:
                by_lang[lang] = Vocabulary(words, hashes, lang)
            ids = numbers(text, by_lang[lang])
            held.setdefault(lang, []).append(ids)
            size[lang] = size.get(lang, 0) + len(ids)
            full = len(words) > VOCABULARY or sum(size.values()) > 2 * window
            if size[lang] >= window or full:
                for each in list(held) if full else [lang]:
                    yield from cut(each)
            if len(words) > VOCABULARY:
                words, hashes, by_lang = [b"."], [0], {}
    for lang in list(held):
        yield from cut(lang)


def hashed_counts(docs: DataFrame, mode: str, parts: int, least: int, proposed: Broadcast | None = None, window: int = WINDOW) -> DataFrame:
    """``(h, c)`` of the phrases of ``docs(text, lang)`` whose hashes are counted at least ``least`` times."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = Bitmap(proposed.value) if proposed else None
        for _, ids, starts, table, _ in windows(batches, window):
            found = [(h[c > 0], c[c > 0]) for _, h, c in window_counts(ids, starts, table, mode, have, None)]
            if found:
                yield by_part(*(np.concatenate(x) for x in zip(*found)), parts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        part, waiting = None, 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            h, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            total = np.zeros(len(h), np.int64)
            np.add.at(total, at, np.concatenate([x for _, x in held]))
            return h, total

        def done() -> pa.RecordBatch:
            h, c = merged()
            return pa.RecordBatch.from_arrays([pa.array(h[c >= least]), pa.array(c[c >= least])], names=["h", "c"])

        for batch in batches:
            for k, h, c in zip(batch.column("part").to_pylist(), batch.column("h"), batch.column("c")):
                if k != part and held:
                    yield done()
                    held, waiting = [], 0
                part = k
                held.append((h.values.to_numpy(), c.values.to_numpy()))
                waiting += len(held[-1][0])
                if waiting > 2 * window + 2 * len(held[0][0]):
                    held = [merged()]
                    waiting = 0
        if held:
            yield done()

    rows = docs.mapInArrow(tidied(count), HASHED).repartition(parts, "part").sortWithinPartitions("part")
    return rows.mapInArrow(tidied(add), "h long, c long")


def spelled_counts(docs: DataFrame, proposed: Broadcast, reached: Broadcast, window: int = WINDOW) -> DataFrame:
    """Partial counts ``(lang, phrase, c)`` of what reached the minimum or may; the phrase ``''`` counts the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, reach = Bitmap(proposed.value), Bitmap(reached.value)
        for lang, ids, starts, table, words in windows(batches, window):
            spelling = pa.array(words, pa.binary())
            phrases, counts = [pa.array([b""])], [np.array([(ids[:starts] > 0).sum()])]
            for spelled, _, c in window_counts(ids, starts, table, "spell", have, reach):
                live = np.flatnonzero(c)
                phrases.append(pc.binary_join_element_wise(*(spelling.take(pa.array(w[live])) for w in spelled), b" "))
                counts.append(c[live])
            text = pa.concat_arrays([p.cast(pa.binary()) for p in phrases]).cast(pa.string())
            named = pa.array([lang.decode()]).take(pa.array(np.zeros(len(text), np.int64)))
            yield pa.RecordBatch.from_arrays([named, text, pa.array(np.concatenate(counts))], names=["lang", "phrase", "c"])

    return docs.mapInArrow(tidied(run), COUNTED)


def frequent(docs: DataFrame, min_count: int = MIN_COUNT, sample_every: int = SAMPLE_EVERY, lowered: float = LOWERED) -> DataFrame:
    """``(lang, phrase, c)`` of all phrases of one to four words with ``min_count`` or more
    occurrences, and under the phrase ``''`` each language's number of words."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = documents(docs, F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    least = max(1, int(lowered * min_count / sample_every))
    chosen = F.pmod(F.xxhash64("doc_id", "text", "lang"), F.lit(sample_every)) == 0
    sample = materialize(docs.where(chosen).select("text", "lang"), "phrases-sample")
    docs = docs.select("text", "lang")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, few = (max(1, -(-size // n)) for n in (PART_BYTES, PART_BYTES * sample_every))

    def spread(hashes: DataFrame, n: int) -> Broadcast:
        return spark.sparkContext.broadcast(bitmap(hashes, n).words)

    short = materialize(hashed_counts(sample, "short", few, least), "phrases-short")
    n_short = short.count()
    pairs = spread(short, n_short)
    longer = materialize(hashed_counts(sample, "long", few, least, pairs), "phrases-long")
    proposed = spread(short.union(longer), n_short + longer.count())
    full = materialize(hashed_counts(docs, "full", parts, min_count, proposed), "phrases-full")
    reached = spread(full, full.count())
    total = spelled_counts(docs, proposed, reached).groupBy("lang", "phrase").agg(F.sum("c").alias("c"))
    return materialize(total.where((F.col("c") >= min_count) | (F.col("phrase") == "")), "phrases-counted")


def ranked(counts: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, absorbed: int = ABSORBED) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)`` from the counts of ``frequent``."""
    phrases = counts.where((F.col("phrase") != "") & (F.col("c") >= min_count))
    words = F.split("phrase", " ")
    named = phrases.select("lang", "phrase", F.col("c").alias("a"), words.alias("w"), F.size(words).alias("k")).where("k > 1")

    def piece(start: Column, size: Column) -> Column:
        return F.array_join(F.slice("w", start, size), " ")

    cuts = named.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", "a", "cut", piece(F.lit(1), F.col("cut")).alias("first"), piece(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest")
    )
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("first"), F.col("c").alias("l")), ["lang", "first"])
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("rest"), F.col("c").alias("r")), ["lang", "rest"])
    score = F.expr("cast((cast(a AS decimal(20, 0)) * 2000000) div (cast(l AS decimal(20, 0)) + cast(r AS decimal(20, 0))) AS long)")
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "cut", "a", "l", "r")).alias("b")).select("lang", "phrase", "b.*")

    inner = F.expr("filter(flatten(transform(sequence(2, k - 1), s -> transform(sequence(1, k - s + 1), i -> array_join(slice(w, i, s), ' ')))), x -> x IS NOT NULL)")
    longer = named.where("k > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("a").alias("longest"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longest").alias("longest"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.coalesce(F.expr(f"100 * longest < {absorbed} * a"), F.lit(True)))

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    sizes = counts.where("phrase = ''").groupBy("lang").agg(F.sum("c").alias("n"))
    return kept.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, sample_every: int = SAMPLE_EVERY, lowered: float = LOWERED) -> DataFrame:
    return ranked(frequent(docs, min_count, sample_every, lowered), min_count, top)


def query(docs: DataFrame) -> DataFrame:
    return collocations(docs)


SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), s AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), o AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS i FROM s, (SELECT unnest(range(1, 5)) AS k) WHERE len(w) >= k)
), n AS (
  SELECT lang, count(*) AS n FROM o WHERE k = 1 GROUP BY lang
), f AS (
  SELECT lang, phrase, k, count(*) AS c FROM o GROUP BY lang, phrase, k HAVING count(*) >= 30
), c AS (
  SELECT lang, phrase, c AS a, k, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), t AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1 : cut], ' ') AS x, array_to_string(w[cut + 1 : k], ' ') AS y
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)
), b AS (
  SELECT t.lang, t.phrase, t.a, t.cut, fx.c AS l, fy.c AS r,
         CAST((CAST(t.a AS HUGEINT) * 2000000) // (CAST(fx.c AS HUGEINT) + fy.c) AS BIGINT) AS score
  FROM t JOIN f AS fx ON fx.lang = t.lang AND fx.phrase = t.x JOIN f AS fy ON fy.lang = t.lang AND fy.phrase = t.y
), m AS (
  SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), d AS (
  SELECT lang, array_to_string(w[i : i + s - 1], ' ') AS phrase, max(a) AS longest
  FROM (SELECT lang, w, a, s, unnest(range(1, k - s + 2)) AS i FROM c, (SELECT unnest(range(2, 4)) AS s) WHERE k > s)
  GROUP BY ALL
), g AS (
  SELECT m.*, row_number() OVER (PARTITION BY m.lang ORDER BY m.score DESC, m.a DESC, m.phrase) AS rank
  FROM m LEFT JOIN d ON d.lang = m.lang AND d.phrase = m.phrase
  WHERE d.longest IS NULL OR 100 * d.longest < 80 * m.a
)
SELECT g.lang, g.rank, g.phrase, g.a, g.l, g.r, n.n, g.score FROM g JOIN n ON n.lang = g.lang WHERE g.rank <= 2000
"""
