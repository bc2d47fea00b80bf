"""SentencePiece models: streaming Viterbi encoding, and decoding.

Positions of a text are boundaries; a piece is an edge between two. A
boundary keeps one back pointer, the last piece of the best path to it. For a
unigram model the best path has the largest sum of scores. For a BPE model
the path is the one that the merges give: a sequence of pieces is the
encoding if and only if each neighbouring pair is, so an edge survives only
where its piece and the piece before it form a valid pair, and each boundary
has exactly one.

Edges are at most as long as the longest piece, so only that many boundaries
can still be extended. Whenever the back-pointer paths of all of them meet in
one boundary, the ids before it are committed and the window moves on: memory
is bounded by the window, whatever the length of the text. Between words the
paths meet at once if no piece continues over the start of a word, which is
proved from the vocabulary; words are then encoded alone, each distinct one
once while it stays in a bounded cache.

Runs of spaces have merges of equal score, which the library applies from the
left; pieces of a word after such a run come from the merges themselves.
"""

from __future__ import annotations

import heapq
import re
import struct

SPACE = "▁"
#: Kinds of pieces and of models, as the model file numbers them.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
CACHE_ENTRIES, PAIR_ENTRIES, CACHED_LENGTH = 250_000, 400_000, 64


def read_model(path: str) -> dict:
    """What encoding needs from a model file; bounded by its vocabulary."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    n = m.normalizer_spec
    if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces:
        raise ValueError("only models that keep texts as they are: no character map, all white space kept")
    if any(p.type in (USER, UNUSED) for p in m.pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    return {
        "pieces": [(p.piece, p.score, p.type) for p in m.pieces],
        "kind": m.trainer_spec.model_type,
        "prefix": n.add_dummy_prefix,
        "suffix": m.trainer_spec.treat_whitespace_as_suffix,
        "bytes": m.trainer_spec.byte_fallback,
    }


class PieceModel:
    def __init__(self, spec: dict):
        if spec["kind"] not in (UNIGRAM, BPE) or spec["suffix"]:
            raise ValueError("only unigram and BPE models with white space before words")
        self.kind, self.prefix = spec["kind"], spec["prefix"]
        self.ids: dict[str, int] = {}
        self.score: list[float] = []
        self.byte_ids, self.unknown = [0] * 256, 0
        self.raw: list[bytes] = []
        for i, (piece, score, kind) in enumerate(spec["pieces"]):
            self.score.append(score)
            if kind == NORMAL:
                self.ids[piece] = i
            elif kind == BYTE:
                self.byte_ids[int(piece[3:5], 16)] = i
            elif kind == UNKNOWN:
                self.unknown = i
            self.raw.append(bytes([int(piece[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else piece.encode())
        self.raw[self.unknown] = " ⁇ ".encode()
        self.fallback = spec["bytes"]
        self.longest = max(map(len, self.ids))
        self.text_of = [p for p, _, _ in spec["pieces"]]
        # A word's start cuts all paths if no piece has a space after another character.
        self.words_apart = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.segment = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+") if self.words_apart else re.compile("(?s).+")
        least = min((self.score[i] for i in self.ids.values()), default=0.0)
        self.unknown_score = least - 10
        self.trie = self._trie()
        if self.kind == BPE:
            self.parts = {i: self._last_merge(p) for p, i in self.ids.items() if len(p) > 1}
            self.whole = {i for p, i in self.ids.items() if len(p) == 1 or self.parts[i]}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.seen: dict[str, bytes] = {}  # words of late, and those of the generation before
        self.older: dict[str, bytes] = {}

    def _trie(self) -> dict:
        root: dict = {}
        for piece, i in self.ids.items():
            node = root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = i
        return root

    # --- BPE: merges, and which pairs they leave apart ---------------------------

    def merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """The pieces that the merges give (best score first, then leftmost), and the parts of the last merge."""
        part = list(text)
        left, right = list(range(-1, len(part) - 1)), [*range(1, len(part)), -1]
        queue: list[tuple[float, int, str, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (i := self.ids.get(part[a] + part[b])) is not None:
                heapq.heappush(queue, (-self.score[i], a, part[a] + part[b], b))

        for a in range(len(part) - 1):
            offer(a, a + 1)
        last = None
        while queue:
            _, a, piece, b = heapq.heappop(queue)
            if right[a] != b or not part[a] or part[a] + part[b] != piece:
                continue  # one of them has been merged meanwhile
            last = (part[a], part[b])
            part[a], part[b] = piece, ""
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [p for p in part if p], last

    def _last_merge(self, piece: str) -> tuple[int, int] | None:
        """The two parts that the merges join last into ``piece``; None if they never give it."""
        got, last = self.merged(piece)
        return (self.ids[last[0]], self.ids[last[1]]) if got == [piece] and last[0] in self.ids and last[1] in self.ids else None

    def valid(self, a: int, b: int) -> bool:
        """Whether the merges of the two pieces' text end with these two pieces.

        Walks back over the merges on both sides of the boundary, latest
        first: the pair is lost if at some moment the two parts beside the
        boundary make a piece that merges before the next step.
        """
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            known = self.pairs[a, b] = self._valid(a, b)
        return known

    def _valid(self, x: int, y: int) -> bool:
        score, text, ids = self.score, self.text_of, self.ids
        limit = float("-inf")  # what merged last among the steps already taken back
        tie = False
        while True:
            both = ids.get(text[x] + text[y])
            if both is not None and (score[both] > limit or (tie and score[both] == limit)):
                return False
            px, py = self.parts.get(x), self.parts.get(y)
            if px is None and py is None:
                return True
            # The later merge of the two is taken back first; at equal scores the right one was later.
            if py is None or (px is not None and score[x] < score[y]):
                limit, tie, x = score[x], False, px[1]
            else:
                limit, tie, y = score[y], True, py[0]

    # --- streaming Viterbi ---------------------------------------------------------

    def stream(self, text: str) -> bytes:
        """The ids of a stretch of text, committed as the paths converge."""
        out: list[int] = []
        start = 0  # first boundary of the window; all before it is committed
        back: list[tuple[int, int] | None] = [None]  # per boundary: (where its last piece starts, id; -1: unknown character)
        best: list[float] = [0.0]
        pending: dict[int, tuple[int, int, float]] = {}  # boundaries ahead of the scan
        n, bpe, trie, score = len(text), self.kind == BPE, self.trie, self.score
        for at in range(n):
            if at > start:
                j, i, s = pending.pop(at)
                back.append((j, i))
                best.append(s)
            own = best[at - start]
            before = back[at - start]
            before_id = before[1] if before else None
            node, stop, single = trie, at, False
            while stop < n and (node := node.get(text[stop])) is not None:
                stop += 1
                i = node.get("")
                if i is None:
                    continue
                single = single or stop == at + 1
                if bpe:  # a boundary has one valid path, so the first that is found is it
                    if stop not in pending and i in self.whole and (before_id is None or before_id < 0 or self.valid(before_id, i)):
                        pending[stop] = (at, i, 0.0)
                else:
                    s = own + score[i]
                    if stop not in pending or s > pending[stop][2]:
                        pending[stop] = (at, i, s)
            if not single and (at + 1 not in pending or own + self.unknown_score > pending[at + 1][2]):
                pending[at + 1] = (at, -1, own + self.unknown_score)
            if at - start >= 4 * self.longest:
                start = self._commit(text, start, at, back, best, pending, out)
        if n:
            path, (j, i, _) = [], pending[n]
            end = n
            while True:
                path.append((j, end, i))
                if j <= start:
                    break
                end = j
                j, i = back[j - start]
            self._emit(text, reversed(path), out)
        return struct.pack(f"<{len(out)}I", *out)

    def word(self, text: str) -> bytes:
        """``stream`` for a short stretch under a BPE model: its window is the stretch itself."""
        n, trie, whole, pairs, valid = len(text), self.trie, self.whole, self.pairs, self.valid
        last, origin = [-2] * (n + 1), [0] * (n + 1)  # last piece before a boundary and its start; -2: none yet, -1: unknown character
        for at in range(n):
            before, node, stop, single = last[at], trie, at, False
            for c in text[at:]:
                node = node.get(c)
                if node is None:
                    break
                stop += 1
                i = node.get("")
                if i is None:
                    continue
                single = single or stop == at + 1
                if last[stop] == -2 and i in whole:
                    if before >= 0:
                        apart = pairs.get((before, i))
                        if not (valid(before, i) if apart is None else apart):
                            continue
                    last[stop], origin[stop] = i, at
            if not single and last[at + 1] == -2:
                last[at + 1], origin[at + 1] = -1, at
        end, out, ends = n, [], [n]
        while end := origin[end]:
            ends.append(end)
        ends.reverse()
        if -1 in last:
            self._emit(text, [(origin[e], e, last[e]) for e in ends], out)
        else:
            out = [last[e] for e in ends]
        return struct.pack(f"<{len(out)}I", *out)

    def _commit(self, text, start, at, back, best, pending, out) -> int:
        """Commits up to the last boundary that all surviving paths share."""
        ends = {j for j, _, _ in pending.values()}
        while len(ends) > 1:  # step the farthest end back until all meet
            far = max(ends)
            ends.remove(far)
            ends.add(back[far - start][0] if far > start else far)
        meet = ends.pop()
        if meet <= start:
            return start
        path, end = [], meet
        while end > start:
            j, i = back[end - start]
            path.append((j, end, i))
            end = j
        self._emit(text, reversed(path), out)
        last = back[meet - start]
        del back[: meet - start], best[: meet - start]
        back[0] = last
        base = best[0]
        best[:] = [b - base for b in best]
        for k, (j, i, s) in pending.items():
            pending[k] = (j, i, s - base)
        return meet

    def _emit(self, text, path, out: list[int]) -> None:
        for a, b, i in path:
            if i >= 0:
                out.append(i)
            elif self.fallback:
                out += [self.byte_ids[x] for x in text[a:b].encode("utf-8")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)  # unknown characters in a row are one piece

    # --- texts ---------------------------------------------------------------------

    def _segment(self, text: str) -> bytes:
        if self.kind == BPE and SPACE + SPACE in text:
            out: list[int] = []
            for p in self.merged(text)[0]:
                self._emit(p, [(0, len(p), self.ids.get(p, -1))], out)
            return struct.pack(f"<{len(out)}I", *out)
        return self.word(text) if self.kind == BPE and len(text) <= CACHED_LENGTH else self.stream(text)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        text = text.replace(" ", SPACE)
        if self.prefix:
            text = SPACE + text
        if not self.words_apart:
            return self.stream(text)
        seen, older, out = self.seen, self.older, []
        for s in self.segment.findall(text):
            ids = seen.get(s)
            if ids is None:
                ids = older.get(s)
                if ids is None:
                    ids = self._segment(s)
                if len(s) <= CACHED_LENGTH:
                    if len(seen) >= CACHE_ENTRIES:
                        self.older = older = seen
                        self.seen = seen = {}
                    seen[s] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        raw = self.raw
        text = b"".join([raw[i] for i in memoryview(ids).cast("I")]).decode("utf-8", errors="replace").replace(SPACE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text
