"""Personal data in documents: patterns, and spans that a conditional random field adds.

Four kinds (``KINDS``) have a pattern and a test each; leftmost
non-overlapping matches that pass are the base spans. A pattern takes
neighbouring numbers for one (a phone number and an address, two cards), and
such a match fails its test as a whole. The random field (``crf``) labels each
word instead, from its shape and those beside it, so it separates them, and it
knows telephone numbers without the international '+'. What it proposes must
pass the test of its kind and overlap no base span.

The field is trained on a small table that labels itself: runs of words with
digits, '@' or '+' from about ``SAMPLE_DOCS`` documents (by a hash of their
text), at most ``LABELLED_RUNS`` distinct runs, labelled by what the patterns
match in them, and as many rows composed of these (neighbours without a word
between, cards in groups, telephones without '+'). Every whole text is then
labelled in one pass without a shuffle.

Defined cases: a null or empty text has no spans; a null id stays null;
repeated rows give repeated results; ties do not arise, as spans of a kind
never overlap; very long texts are read run by run, in linear time; if the
sample holds no run, only the patterns speak; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlstats.llm.common import documents, map_batches
from crawlstats.llm.crf import EDGE, PLAIN, Crf, Features, fine_shape

KINDS = ("email", "ip", "card", "phone")
#: Documents that labelled runs are taken from, in expectation.
SAMPLE_DOCS = 20_000
#: Distinct labelled runs at most.
LABELLED_RUNS = 4_000
#: Longest run that becomes a training row, in words.
ROW_WORDS = 16

# Possessive repeats and the look-behind find what the plain patterns find, in linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z])\(?[0-9]{2,4}[).\x20-]{1,2}[\x20().0-9-]*[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D0-9@+]++(?:([0-9@+])[^\x20\x09-\x0D]*+)?|([0-9@+])[^\x20\x09-\x0D]*+")
_SPECIAL = re.compile("[0-9@+]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")

Span = tuple[int, int]


def words(text: str) -> list[str]:
    return _TOKEN.findall(text)


def digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(number: str) -> bool:
    """Whether the digits pass the check sum of card numbers."""
    odd, even = number[-1::-2], number[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def _octets(match: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in match.split("."))


PASSES = {
    "email": lambda m: True,
    "ip": _octets,
    "card": lambda m: 13 <= len(d := digits(m)) <= 19 and luhn(d),
    "phone": lambda m: 9 <= len(digits(m)) <= 15,
}


def emails(text: str) -> Iterator[Span]:
    """Matches of ``[A-Za-z0-9._%+-]+@`` and a domain, found from the '@' outwards."""
    end = 0
    at = text.find("@")
    while at >= 0:
        if at >= end and (m := _DOMAIN.match(text, at + 1)):
            before = text[end:at]
            start = end + len(before.rstrip(_LOCAL))
            if start < at:
                yield start, m.end()
                end = m.end()
        # What stands before this '@' can be part of no later local part.
        end = max(end, at + 1)
        at = text.find("@", max(at + 1, end))


def matches(kind: str, text: str) -> Iterator[Span]:
    """Leftmost non-overlapping matches of a kind's pattern, before its test."""
    if kind == "email":
        return emails(text)
    pattern = {"ip": _IP, "card": _CARD, "phone": _PHONE}[kind]
    return (m.span() for m in pattern.finditer(text))


def base_spans(text: str) -> dict[str, list[Span]]:
    """The spans of each kind that its pattern matches and its test passes."""
    some = _SPECIAL.search(text)
    return {k: [(a, b) for a, b in matches(k, text) if PASSES[k](text[a:b])] if some else [] for k in KINDS}


def runs(text: str) -> Iterator[tuple[list[Span], str, str]]:
    """Runs of words with a digit, '@' or '+': their places, and the shapes beside the run."""
    run: list[Span] = []
    before = EDGE
    for m in _WORD.finditer(text):
        if m.lastindex:
            run.append(m.span())
            continue
        if run:
            yield run, before, PLAIN
            run = []
        before = PLAIN
    if run:
        yield run, before, EDGE


def chain(text: str, run: list[Span], before: str, after: str) -> tuple[str, ...]:
    return (before, *(fine_shape(text[a:b]) for a, b in run), after)


# --- the labelled table ------------------------------------------------------


def labelled(text: str) -> list[str] | None:
    """Labels of a run's words by what the patterns match; None where a match fails for its length.

    A number of a card's length counts as one whether its check sum is right
    or not: the shape does not show it.
    """
    places = [m.span() for m in _TOKEN.finditer(text)]
    labels = ["O"] * len(places)
    for kind in ("email", "phone", "ip", "card"):
        for a, b in matches(kind, text):
            hit = [i for i, (x, y) in enumerate(places) if x < b and a < y]
            if any(labels[i] != "O" for i in hit):
                continue
            n = len(digits(text[a:b]))
            if kind == "card" and n > 19 or kind == "phone" and n > 15:
                return None
            if not _formed(kind, text[a:b]):
                continue
            for j, i in enumerate(hit):
                labels[i] = f"{'I' if j else 'B'}-{kind}"
    return labels


def _formed(kind: str, match: str) -> bool:
    """Whether a match has its kind's form; a card needs no right check sum."""
    return 13 <= len(digits(match)) <= 19 if kind == "card" else PASSES[kind](match)


def compositions(rows: list[str], seed: int = 5) -> list[list[tuple[str, str]]]:
    """Rows of (text, kind) made of the spans in the given ones: neighbours, grouped cards, telephones without '+'."""
    draw = np.random.default_rng(seed)
    spans = {k: sorted({r[a:b] for r in rows for a, b in matches(k, r) if _formed(k, r[a:b])}) for k in KINDS}
    for number in [digits(n) for n in spans["card"]]:
        spans["card"].append(" -"[draw.integers(2)].join(number[i : i + 4] for i in range(0, len(number), 4)))
    local = sorted({re.sub(r"^\+[0-9]{1,3}[\x20.-]?", "", p) for p in spans["phone"]})
    spans["phone"] += [p for p in local if _LOCAL_PHONE.fullmatch(p) and _formed("phone", p)]
    kinds, after = [k for k in KINDS if spans[k]], ("", "", "", ".", ",", "!!")
    out = []
    for _ in rows if kinds else ():
        some = [kinds[i] for i in draw.integers(len(kinds), size=draw.integers(1, 4))]
        out.append([(spans[k][draw.integers(len(spans[k]))] + after[draw.integers(len(after))], k) for k in some])
    return out


def train(texts: list[str]) -> Crf | None:
    """The field for the given runs, or None without any."""
    rows = [(words(t), y) for t in texts if (y := labelled(t)) and len(y) <= ROW_WORDS]
    for parts in compositions(texts):
        each = [(words(t), k) for t, k in parts]
        rows.append(([w for ws, _ in each for w in ws], [f"{'I' if j else 'B'}-{k}" for ws, k in each for j in range(len(ws))]))
    if not rows:
        return None
    shaped = [((PLAIN, *map(fine_shape, w), PLAIN), y) for w, y in rows]
    shapes = Counter(s for chain, _ in shaped for s in chain)
    shapes[EDGE] += 2
    return Crf(KINDS, Features(shapes)).fit(shaped)


def labelled_runs(docs: DataFrame) -> list[str]:
    """Distinct runs of the sample, at most ``LABELLED_RUNS``, those with the smallest hashes."""
    n = max(1, docs.count())
    h = F.pmod(F.xxhash64("text"), F.lit(1 << 31))
    sample = docs.where(F.col("text").rlike("[0-9@+]") & (h < int((1 << 31) * min(1.0, SAMPLE_DOCS / n))))

    def cut(batches):
        for b in batches:
            found = {t[run[0][0] : run[-1][1]] for t in b.column(0).to_pylist() for run, _, _ in runs(t) if len(run) <= ROW_WORDS and run[-1][1] - run[0][0] <= 1024}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["run"])

    found = map_batches(sample.select("text"), cut, "run string").distinct()
    return [r.run for r in found.orderBy(F.xxhash64("run"), "run").limit(LABELLED_RUNS).collect()]


# --- documents ---------------------------------------------------------------


def proposals(text: str, run: list[Span], labels: np.ndarray, names: list[str]) -> Iterator[tuple[str, Span]]:
    """(kind, place) of each span that the labels of a run mark."""
    i = 0
    while i < len(run):
        name, j = names[labels[i]], i + 1
        if name != "O":
            while j < len(run) and names[labels[j]] == f"I-{name[2:]}":
                j += 1
            yield name[2:], (run[i][0], run[j - 1][1])
        i = j


def accepted(kind: str, text: str, start: int, end: int) -> Span | None:
    """The part of a proposed span that is a whole match of its kind."""
    part = text[start:end]
    found = list(matches(kind, part))
    if kind == "phone" and not found:
        found = [m.span() for m in _LOCAL_PHONE.finditer(part)]
    passing = [(a, b) for a, b in found if PASSES[kind](part[a:b])]
    return (start + passing[0][0], start + passing[0][1]) if len(passing) == 1 else None


class Finder:
    """Spans of texts; best labels of repeated shape sequences are kept, up to a bound."""

    CACHED = 100_000

    def __init__(self, model: Crf | None):
        self.model, self.best = model, {}

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int, bool]]]:
        """(kind, start, end, base) of each text, by kind and start."""
        base = [base_spans(t) for t in texts]
        todo = []
        if self.model:
            todo = [(i, run, chain(t, run, p, q)) for i, t in enumerate(texts) if _SPECIAL.search(t) for run, p, q in runs(t)]
            new = list({c for _, _, c in todo} - self.best.keys())
            if len(self.best) + len(new) > self.CACHED:
                self.best.clear()
                new = list({c for _, _, c in todo})
            self.best.update(zip(new, self.model.decode(new)))
        more: dict[int, list] = {}
        for i, run, shapes in todo:
            for kind, (a, b) in proposals(texts[i], run, self.best[shapes], self.model.labels):
                if span := accepted(kind, texts[i], a, b):
                    more.setdefault(i, []).append((kind, *span))
        out = []
        for i, by_kind in enumerate(base):
            rows = [(k, a, b, True) for k in KINDS for a, b in by_kind[k]]
            if i in more:
                taken = sorted((a, b) for _, a, b, _ in rows)
                starts = np.array([a for a, _ in taken])
                reach = np.maximum.accumulate([b for _, b in taken]) if taken else starts
                for k, a, b in more[i]:
                    j = np.searchsorted(starts, b) - 1  # the last base span that starts before this one ends
                    if j < 0 or reach[j] <= a:
                        rows.append((k, a, b, False))
                rows.sort(key=lambda r: (KINDS.index(r[0]), r[1]))
            out.append(rows)
        return out


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): the spans of every document, code points, end exclusive, by kind and start."""
    docs = documents(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(train(labelled_runs(docs)))

    def find(batches):
        finder = Finder(model.value)
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e, "base": own} for k, s, e, own in rows] for rows in finder.spans(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, SPANS)], ["doc_id", "spans"])

    return map_batches(docs, find, "doc_id long, spans array<struct<kind: string, start: bigint, end: bigint, base: boolean>>")
