"""Personal data by patterns and a skip-chain conditional random field.

Base spans come from four patterns (email, ip, card, phone), leftmost and
non-overlapping per kind, kept if they pass their kind's check.  The field adds
mentions that the patterns miss: spelled-out addresses (``x [at] y [dot] org``),
defanged addresses (``10[.]0[.]0[.]1``), card numbers with other separators, and
numbers that repeat a known phone or card number in another form.

Nodes are the base spans and the candidates of one document; labels are none and
the four kinds.  Factors:

* node: what the span's normal form looks like and its number of digits;
* chain: neighbours at most ``NEAR`` characters apart;
* skip: spans anywhere in the document with the same normal form, or the same
  last digits, share a potential for their labels.  Spans of one form are linked
  one to the next and to the nearest observed ones, so a form that occurs n times
  has 3 n links at most.

Weights are trained piecewise: one pass counts, over all documents, which labels
each factor sees (base spans as labels; candidates linked to a base span are
latent and left out), and a factor's log-potential is the smoothed log of those
counts.  ``MISS`` is the assumed share of mentions that the patterns miss, ``BREAK``
that of equal forms with different labels.  Base spans are observed; loopy
sum-product messages give the others' labels.

Defined cases: a null or empty text has no spans (and the digest of the empty
string); repeated rows give a row each; a null ``doc_id`` is kept; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnlens.llm.common import documents, small_batches, tidied

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)  # label of what is no personal data
LABELS = NONE + 1
NEAR = 40
MISS, BREAK = 0.02, 0.01
#: Counts of each cell before anything is seen, and of skip links between equal labels.
SMOOTH, SAME = 0.5, 100.0
ROUNDS, DAMPING, SURE = 30, 0.3, 0.5

DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

AT = r"\s?(?:\[\s?(?:at|@)\s?\]|\(\s?(?:at|@)\s?\)|\{\s?(?:at|@)\s?\})\s?"
DOT = r"\s?(?:\[\s?(?:dot|\.)\s?\]|\(\s?(?:dot|\.)\s?\)|\{\s?(?:dot|\.)\s?\})\s?"
NAME = r"[A-Za-z0-9-]{1,63}"
SPELLED = re.compile(rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}(?:(?:{AT}){NAME}(?:(?:{DOT}|\.| dot ){NAME})+|@{NAME}(?:{DOT}{NAME})+| at {NAME}(?: dot {NAME})+)")
DEFANGED = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)|\.)[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])")
GROUPED_CARD = re.compile(r"(?<![0-9.])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}(?![0-9])")
NUMBER = re.compile(r"(?<![0-9])\(?[0-9](?:[ .()/-]{0,2}[0-9]){6,18}(?![0-9])")
#: Every match of ``SPELLED``, and every one of ``DEFANGED`` that counts, has one of these.
MARK = re.compile(r"[\[({]\s?(?i:at|@|dot|\.)| (?i:dot) ")
SPELLING = [(re.compile(rf"(?i){AT}"), "@"), (re.compile(rf"(?i){DOT}"), "."), (re.compile("(?i) at "), "@"), (re.compile("(?i) dot "), ".")]

Span = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k & 1:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(DIGIT.findall(s))


def address(s: str) -> str | None:
    """The four parts without leading zeros, if each is 255 at most."""
    parts = [p.lstrip("0") or "0" for p in re.findall("[0-9]+", s)]
    return ".".join(parts) if all(len(p) <= 3 and int(p) <= 255 for p in parts) else None


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, in linear time: each @ with a
    domain takes the local characters before it, back to the last match."""
    out, free = [], 0
    for m in DOMAIN.finditer(text):
        start = at = m.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            out.append((start, m.end()))
            free = m.end()
    return out


def base_spans(text: str) -> list[Span]:
    """Base spans by start, then kind."""
    out: list[Span] = [(*s, 0) for s in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        if "." in text:
            out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if address(m.group())]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := only_digits(m.group())) <= 19 and luhn(d):
                out.append((m.start(), m.end(), 2))
        if "+" in text:
            out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 10 <= len(only_digits(m.group())) <= 15]
    return sorted(out)


@dataclass
class Node:
    start: int
    end: int
    form: str  # feature of the node factor
    allowed: tuple[int, ...]  # kinds it may be
    keys: list[tuple[str, str]] = field(default_factory=list)  # (skip factor, shared form)
    label: int | None = None  # observed kind


def number_keys(digits: str) -> list[tuple[str, str]]:
    return [("same", digits)] + ([("tail", digits[-7:])] if len(digits) <= 15 else [])


def base_node(text: str, span: Span) -> Node:
    start, end, kind = span
    s = text[start:end]
    if kind == 0:
        return Node(start, end, "email", (0,), [("same", s.lower())], kind)
    if kind == 1:
        return Node(start, end, "ip", (1,), [("same", address(s))], kind)
    digits = only_digits(s)
    return Node(start, end, KINDS[kind], (kind,), number_keys(digits), kind)


def candidates(text: str, base: list[Span]) -> list[Node]:
    """Spans, clear of the base spans and of each other, that may be personal data in another form."""
    found: list[Node] = []
    if MARK.search(text):
        for m in SPELLED.finditer(text):
            s = m.group()
            for pattern, plain in SPELLING:
                s = pattern.sub(plain, s)
            if emails(s) == [(0, len(s))]:
                found.append(Node(m.start(), m.end(), "email", (0,), [("same", s.lower())]))
        for m in DEFANGED.finditer(text):
            if not m.group().replace(".", "").isdigit() and (form := address(m.group())):
                found.append(Node(m.start(), m.end(), "ip", (1,), [("same", form)]))
    if DIGIT.search(text):
        for m in GROUPED_CARD.finditer(text):
            if 14 <= len(d := only_digits(m.group())) <= 19 and luhn(d):
                found.append(Node(m.start(), m.end(), "card", (2,), number_keys(d)))
        for m in NUMBER.finditer(text):
            d = only_digits(m.group())
            allowed = tuple(k for k, fits in ((2, len(d) >= 14), (3, len(d) <= 15)) if fits)
            found.append(Node(m.start(), m.end(), f"number{len(d)}", allowed, number_keys(d)))
    taken: list[tuple[int, int]] = []  # disjoint
    for start, end, _ in base:
        if taken and start < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(end, taken[-1][1]))
        else:
            taken.append((start, end))
    out: list[Node] = []
    for node in sorted(found, key=lambda n: (n.form.startswith("number"), n.start)):
        k = bisect_left(taken, (node.start, node.end))
        if (k == 0 or taken[k - 1][1] <= node.start) and (k == len(taken) or node.end <= taken[k][0]):
            insort(taken, (node.start, node.end))
            out.append(node)
    return sorted(out, key=lambda n: n.start)


def links(nodes: list[Node]) -> list[tuple[str, int, int]]:
    """``(factor, i, j)``: chain links of near neighbours; skip links of equal forms, from
    each node to the one before and, if it isn't observed, to the observed one next to it."""
    out = [("chain", i, i + 1) for i in range(len(nodes) - 1) if nodes[i + 1].start - nodes[i].end <= NEAR]
    found: dict[tuple[int, int], str] = {}
    for order in (range(len(nodes)), range(len(nodes) - 1, -1, -1)):
        last: dict[tuple[str, str], int] = {}
        seen: dict[tuple[str, str], int] = {}
        for j in order:
            for key in nodes[j].keys:
                near = [last.get(key)] if order.step > 0 else []
                if nodes[j].label is None:
                    near.append(seen.get(key))
                else:
                    seen[key] = j
                for i in near:
                    if i is not None:
                        found.setdefault((min(i, j), max(i, j)), key[0])
                last[key] = j
    return out + [(factor, i, j) for (i, j), factor in sorted(found.items())]


FACTORS = ("chain", "same", "tail")


@dataclass
class Field:
    """Log-potentials: ``nodes[form][label]`` and ``pairs[factor][label, label]``."""

    nodes: dict[str, np.ndarray]
    pairs: dict[str, np.ndarray]

    @classmethod
    def of(cls, counts: dict[tuple[str, int, int], float]) -> Field:
        """From counts ``(form, label, -1)`` and ``(factor, label, label)``."""
        forms: dict[str, np.ndarray] = defaultdict(lambda: np.full(LABELS, SMOOTH))
        joint = {f: np.full((LABELS, LABELS), SMOOTH) + np.eye(LABELS) * (SAME if f != "chain" else 0) for f in FACTORS}
        for (name, a, b), n in counts.items():
            if b < 0:
                forms[name][a] += n
            else:
                joint[name][a, b] += n
                joint[name][b, a] += n
        nodes = {f: np.log((1 - MISS) * c / c.sum() + MISS / 2) for f, c in forms.items()}
        pairs = {}
        for f, c in joint.items():
            p = c / c.sum()
            given = p / p.sum(1, keepdims=True)  # a label given its neighbour's
            if f == "chain":  # against labels at large, and halfway to them
                w = np.log((given + p.sum(0)) / (2 * p.sum(0)))
            else:
                w = np.log((1 - BREAK) * given + BREAK / LABELS)
            pairs[f] = (w + w.T) / 2
        return cls(nodes, pairs)

    def unary(self, node: Node) -> np.ndarray:
        out = np.full(LABELS, -1e3)
        if node.label is not None:
            out[node.label] = 0.0
            return out
        known = self.nodes.get(node.form)
        if known is None:
            known = np.full(LABELS, np.log(MISS / 2))
            known[NONE] = np.log(1 - MISS)
        for k in (*node.allowed, NONE):
            out[k] = known[k]
        return out

    def beliefs(self, nodes: list[Node]) -> np.ndarray:
        """Label probabilities of every node, by loopy sum-product messages."""
        unary = np.array([self.unary(n) for n in nodes])
        edges = links(nodes)
        if edges:
            a = np.array([i for _, i, _ in edges] + [j for _, _, j in edges])
            b = np.array([j for _, _, j in edges] + [i for _, i, _ in edges])
            w = np.array([self.pairs[f] for f, _, _ in edges] * 2)  # symmetric
            back = np.r_[len(edges) : 2 * len(edges), 0 : len(edges)]
            message = np.zeros((len(a), LABELS))
            for _ in range(ROUNDS):
                total = unary.copy()
                np.add.at(total, b, message)
                inward = total[a] - message[back]
                new = np.logaddexp.reduce(inward[:, :, None] + w, axis=1)
                new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
                step = np.abs(new - message).max()
                message = DAMPING * message + (1 - DAMPING) * new
                if step < 1e-4:
                    break
            np.add.at(unary, b, message)
        return np.exp(unary - np.logaddexp.reduce(unary, axis=1, keepdims=True))


def added_spans(text: str, base: list[Span], model: Field) -> list[Span]:
    extra = candidates(text, base)
    if not extra:
        return []
    nodes = sorted([base_node(text, s) for s in base] + extra, key=lambda n: (n.start, n.end))
    p = model.beliefs(nodes)
    out = []
    for node, q in zip(nodes, p):
        if node.label is None and (k := int(q.argmax())) != NONE and q[k] > SURE:
            out.append((node.start, node.end, k))
    return out


def factor_counts(text: str) -> Counter:
    """What the factors see in one document."""
    out: Counter = Counter()
    base = base_spans(text)
    extra = candidates(text, base)
    if not base and not extra:
        return out
    nodes = sorted([base_node(text, s) for s in base] + extra, key=lambda n: (n.start, n.end))
    known = {key for n in nodes if n.label is not None for key in n.keys}
    label: list[int | None] = []
    for n in nodes:
        latent = n.label is None and (not n.form.startswith("number") or any(k in known for k in n.keys))
        label.append(None if latent else NONE if n.label is None else n.label)
        if label[-1] is not None:
            out[n.form, label[-1], -1] += 1
    for factor, i, j in links(nodes):
        if label[i] is not None and label[j] is not None:
            out[factor, label[i], label[j]] += 1
            if factor == "same" and len(nodes[i].keys) == len(nodes[j].keys) == 2:
                out["tail", label[i], label[j]] += 1  # equal digits have equal last digits
    return out


def train(docs: DataFrame) -> Field:
    """The field's weights from all documents (the driver gets a few hundred counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                total.update(factor_counts(text.as_py()))
        keys = list(total)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.int32()), pa.array([total[k] for k in keys], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["name", "a", "b", "n"])

    counts = documents(docs).mapInArrow(tidied(run), "name string, a int, b int, n long").groupBy("name", "a", "b").agg(F.sum("n").alias("n"))
    return Field.of({(r.name, r.a, r.b): r.n for r in counts.collect()})


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1])))


def find(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)``; the counts are of base spans."""
    model = model or train(docs)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    types = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                raw = text.as_py()
                base = base_spans(raw)
                more = added_spans(raw, base, model)
                n = Counter(k for _, _, k in base)
                rows.append((doc_id, *(n[k] for k in range(NONE)), hashlib.sha256(written(base).encode()).hexdigest(), written(base + more), len(more)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)

    return documents(docs).mapInArrow(tidied(run), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with each span (overlapping ones as one) replaced by its kind in brackets."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Field | None = None, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``, with the personal data in the text replaced by its
    kind; ``size_col``, if there, becomes the new text's length."""
    small_batches(docs.sparkSession)
    model = model or train(docs)
    schema = docs.schema
    size_col = size_col if size_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts, changed = [], False
            for value in batch.column(at):
                raw = value.as_py()
                if raw:
                    base = base_spans(raw)
                    if spans := base + added_spans(raw, base, model):
                        raw, changed = redacted(raw, spans), True
                texts.append(raw)
            if changed:
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                if size_col:
                    k = batch.schema.get_field_index(size_col)
                    old = batch.column(k).to_pylist()
                    new = [o if t is None or o is None else len(t) for o, t in zip(old, texts)]
                    batch = batch.set_column(k, batch.schema.field(k), pa.array(new, batch.schema.field(k).type))
            yield batch

    return docs.mapInArrow(tidied(run), schema)


def query(docs: DataFrame) -> DataFrame:
    return find(docs)
