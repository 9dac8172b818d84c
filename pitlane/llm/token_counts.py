"""Token counts by a compiled finite-state transducer over chunks of text.

The pre-tokenizer of a byte-level BPE is compiled into a deterministic
transducer over character classes. Each transition says whether a piece starts
at the character read or at the one before it; the transition that closes a
piece carries that piece's number of BPE tokens. Texts are joined with an END
symbol, cut into chunks of equal length, and every chunk is run from all states
at once, which gives its state map; the maps are composed by a parallel prefix
scan, so every chunk then knows its true first state and emits its counts
without waiting for the chunks before it.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pitlane.llm.shared import text_chunks

# Character classes of the transducer.
LETTER, NUMBER, OTHER, SPACE, WHITE, QUOTE, _S, _R, _V, _L, _E, END = range(12)
CLASSES = 12
# States. AFTER_QUOTE and the three after it wait to see whether a contraction comes.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, AFTER_WHITE, AFTER_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(10)
STATES = 10
# Outputs of a transition: a piece starts at this character, at the one before it.
HERE, BEFORE = 1, 2
#: Planes beyond hold no letters, numbers or white space: tags, private use and unassigned points.
ASSIGNED = 0x40000
#: Characters in a chunk.
CHUNK = 256
#: Distinct pieces whose counts a worker keeps; beyond it the table starts anew.
KEPT_PIECES = 1_000_000
#: Longer pieces are counted by the heap, shorter ones in vectorised groups.
LONG_PIECE = 64


def compile_transitions() -> tuple[np.ndarray, np.ndarray]:
    """(next state, output) by state and class, flat.

    Pieces: the contractions 's 't 're 've 'm 'll 'd; runs of letters, of numbers
    and of other characters, each with one space before it; and white space,
    whose last character stands alone before a piece that it isn't part of."""
    into = np.zeros((STATES, CLASSES), np.uint8)
    out = np.zeros((STATES, CLASSES), np.uint8)
    letters = (LETTER, _S, _R, _V, _L, _E)
    run = {**dict.fromkeys(letters, IN_LETTERS), NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: AFTER_QUOTE, SPACE: AFTER_SPACE, WHITE: AFTER_WHITE, END: START}
    white = (SPACE, WHITE)
    for state in range(STATES):
        for c in range(CLASSES):
            to, mark = run[c], HERE if c != END else 0
            same = state == to or state == IN_OTHERS and c == QUOTE
            if state in (IN_LETTERS, IN_NUMBERS, IN_OTHERS) and same:
                to, mark = state, 0
            elif state in (AFTER_SPACE, AFTER_WHITE) and c in white:
                mark = 0
            elif state == AFTER_SPACE and c != END:  # the space belongs to the piece that begins
                to, mark = IN_OTHERS if c == QUOTE else to, BEFORE
            elif state == AFTER_WHITE and c != END:
                mark = BEFORE | HERE
            elif state == AFTER_QUOTE:
                if c == _S:
                    to, mark = START, 0
                elif c in (_R, _V, _L):
                    to, mark = {_R: QUOTE_R, _V: QUOTE_V, _L: QUOTE_L}[c], 0
                elif c in (OTHER, QUOTE):
                    to, mark = IN_OTHERS, 0
            elif state in (QUOTE_R, QUOTE_V, QUOTE_L):
                if c == (_L if state == QUOTE_L else _E):
                    to, mark = START, 0
                else:  # no contraction: the quote was a piece, and letters began after it
                    mark = BEFORE | (0 if c in letters or c == END else HERE)
            into[state, c], out[state, c] = to, mark
    return into.ravel(), out.ravel()


def character_classes(tokenizer) -> np.ndarray:
    """Class of every code point, read off the tokenizer's own pre-tokenizer."""
    table = np.full(0x110000, OTHER, np.uint8)
    points = [c for c in range(ASSIGNED) if not 0xD800 <= c < 0xE000]
    table[:ASSIGNED] = WHITE
    for lead, mark in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
        for at in range(0, len(points), 1 << 16):
            part = points[at: at + (1 << 16)]
            # each point stands between the lead and a letter or number that the lead never joins
            gap = "1" if lead == "a" else "a"
            text = "".join(f"{lead}{chr(c)}{gap}" for c in part)
            starts = {s for _, (s, _) in tokenizer.pre_tokenizer.pre_tokenize_str(text)}
            joined = [c for k, c in enumerate(part) if 3 * k + 1 not in starts]
            table[joined] = mark
    table[ord(" ")], table[ord("'")] = SPACE, QUOTE
    for c, mark in (("s", _S), ("t", _S), ("m", _S), ("d", _S), ("r", _R), ("v", _V), ("l", _L), ("e", _E)):
        table[ord(c)] = mark
    return table


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def compile_tokenizer(path: str) -> dict:
    """Everything a task needs, from a byte-level BPE file: a few MB whatever the corpus."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"]
    if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError(f"{path}: only byte-level BPE without prefix space and normaliser is compiled")
    vocab = model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in merges], np.int64)
    right = np.array([vocab[b] for _, b in merges], np.int64)
    keys = left << 32 | right
    order = np.argsort(keys, kind="stable")
    return {
        "classes": character_classes(Tokenizer.from_file(path)), "bytes": np.array([vocab[c] for c in _byte_letters()], np.int64),
        "keys": keys[order], "ranks": order.astype(np.int64), "made": np.array([vocab[a + b] for a, b in merges], np.int64),
        "special": sorted((t["content"] for t in spec.get("added_tokens", ())), key=len, reverse=True),
    }


class Counter:
    """Counts tokens of texts; one for each Python worker."""

    def __init__(self, compiled: dict):
        self.c = compiled
        self.into, self.out = compile_transitions()
        self.pieces: dict[bytes, int] = {}
        self.special = [s.encode() for s in compiled["special"]]

    # -- the transducer -------------------------------------------------------------------------

    def piece_starts(self, classes: np.ndarray) -> np.ndarray:
        """Where pieces start in a stream of classes that ends with END."""
        n = len(classes)
        rows = -(-n // CHUNK)
        padded = np.full(rows * CHUNK, END, np.int64)
        padded[:n] = classes
        steps = np.ascontiguousarray(padded.reshape(rows, CHUNK).T)
        maps = np.tile(np.arange(STATES, dtype=np.int64), (rows, 1))
        for column in steps:
            maps = self.into[maps * CLASSES + column[:, None]].astype(np.int64)
        first = self.first_states(maps)
        marks = np.empty((CHUNK, rows), np.uint8)
        state = first
        for j, column in enumerate(steps):
            at = state * CLASSES + column
            marks[j] = self.out[at]
            state = self.into[at].astype(np.int64)
        marks = marks.T.ravel()[:n]
        starts = (marks & HERE).astype(bool)
        starts[:-1] |= (marks[1:] & BEFORE).astype(bool)
        return np.flatnonzero(starts)

    @staticmethod
    def first_states(maps: np.ndarray) -> np.ndarray:
        """First state of each chunk: the maps before it composed, by doubling steps."""
        scan, step = maps.copy(), 1
        while step < len(scan):
            later = np.take_along_axis(scan[step:], scan[:-step], axis=1)
            scan = np.concatenate([scan[:step], later])
            step *= 2
        first = np.zeros(len(maps), np.int64)
        first[1:] = scan[:-1, START]
        return first

    # -- tokens of a piece ----------------------------------------------------------------------

    def _rank(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.c["keys"], keys), len(self.c["keys"]) - 1)
        return np.where(self.c["keys"][at] == keys, self.c["ranks"][at], np.iinfo(np.int64).max)

    def _count_group(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of pieces of like length: each round merges every piece's first pair of least rank."""
        width = max(map(len, pieces))
        ids = np.full((len(pieces), width + 1), -1, np.int64)
        for k, p in enumerate(pieces):
            ids[k, : len(p)] = self.c["bytes"][np.frombuffer(p, np.uint8)]
        counts, at = np.array([len(p) for p in pieces]), np.arange(len(pieces))
        columns = np.arange(width + 1)
        none = np.iinfo(np.int64).max
        while len(ids):
            rank = np.where(ids[:, 1:] >= 0, self._rank(ids[:, :-1] << 32 | np.maximum(ids[:, 1:], 0)), none)
            best = rank.argmin(axis=1)
            least = rank[np.arange(len(ids)), best]
            more = least < none
            ids, at, best, least = ids[more], at[more], best[more], least[more]
            if not len(ids):
                break
            source = np.minimum(columns + (columns > best[:, None]), width)
            ids = np.take_along_axis(ids, source, axis=1)
            ids[:, -1] = -1
            ids[np.arange(len(ids)), best] = self.c["made"][least]
            counts[at] -= 1
        return counts

    def _count_long(self, piece: bytes) -> int:
        """Tokens of one long piece, with a heap of its pairs."""
        ids = self.c["bytes"][np.frombuffer(piece, np.uint8)]
        n = len(ids)
        none = np.iinfo(np.int64).max
        first = self._rank(ids[:-1] << 32 | ids[1:])
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first.tolist()) if r != none]
        heapq.heapify(heap)
        count = n
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.c["made"][r]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            count -= 1
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n:
                    rank = int(self._rank(np.array([ids[x] << 32 | ids[y]]))[0])
                    if rank != none:
                        heapq.heappush(heap, (rank, x, ids[x], ids[y]))
        return count

    def piece_counts(self, pieces: list[bytes]) -> list[int]:
        """Tokens of each piece; unseen pieces are compiled together and kept."""
        new = sorted({p for p in pieces if p not in self.pieces}, key=len)
        if len(self.pieces) + len(new) > KEPT_PIECES:
            self.pieces, new = {}, sorted(set(pieces), key=len)
        at = 0
        while at < len(new) and len(new[at]) <= LONG_PIECE:
            end = at
            while end < len(new) and len(new[end]) <= min(LONG_PIECE, max(4, len(new[at]) * 3 // 2)) and end - at < 20_000:
                end += 1
            self.pieces.update(zip(new[at:end], self._count_group(new[at:end]).tolist()))
            at = end
        self.pieces.update((p, self._count_long(p)) for p in new[at:])
        return [self.pieces[p] for p in pieces]

    # -- texts ----------------------------------------------------------------------------------

    def count_texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each row of the joined UTF-8 bytes. Special strings count one each and part the text."""
        raw = data.tobytes()
        total = np.zeros(len(offsets) - 1, np.int64)
        cuts, specials = set(offsets.tolist()), set()
        ends = 0
        found = {s: raw.find(s) for s in self.special}
        while any(i >= 0 for i in found.values()):
            at, _, s = min((i, -len(s), s) for s, i in found.items() if i >= 0)
            row = int(np.searchsorted(offsets, at, "right")) - 1
            whole = at >= ends and at + len(s) <= offsets[row + 1]  # not across two rows
            if whole:
                total[row] += 1
                ends = at + len(s)
                specials.add(at)
                cuts |= {at, ends}
            for x, i in found.items():
                if 0 <= i < (ends if whole else at + 1):
                    found[x] = raw.find(x, ends if whole else at + 1)
        # the stream: what stands between two cuts and isn't a special string, each followed by END
        cuts = sorted(cuts)
        segments = [(a, b) for a, b in zip(cuts, cuts[1:]) if a not in specials]
        if not segments:
            return total
        text = raw.decode("utf-8")
        points = self.c["classes"][np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        bounds = np.searchsorted(lead, np.array(segments, np.int64))
        classes, byte_at = [], []
        for (a, b), (i, j) in zip(segments, bounds.tolist()):
            classes += [points[i:j], np.array([END], np.uint8)]
            byte_at += [lead[i:j], np.array([b])]
        classes, byte_at = np.concatenate(classes), np.concatenate(byte_at)
        starts = self.piece_starts(classes)
        begin = byte_at[starts]
        end = np.empty_like(begin)
        stops = np.array([b for _, b in segments])
        limit = stops[np.searchsorted(stops, begin, "right")]
        end[:-1] = np.minimum(begin[1:], limit[:-1])
        end[-1] = limit[-1]
        pieces = [raw[a:b] for a, b in zip(begin.tolist(), end.tolist())]
        rows = np.searchsorted(offsets, begin, "right") - 1
        total += np.bincount(rows, weights=self.piece_counts(pieces), minlength=len(total)).astype(np.int64)
        return total


#: A worker's counters by tokenizer file: pieces that one task has compiled serve the next.
_counters: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, id_col: str, text_col: str, tokenizer_path: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of `docs`.

    Counts are those of the byte-level BPE in the file `tokenizer_path`, without
    begin, end or padding tokens; its special strings inside a text are special
    tokens. The file is read and compiled on the driver; tasks get the compiled
    tables (a few MB, a constant). A null or empty text has 0 tokens; null,
    repeated and tied ids stay rows of their own; other columns are ignored.
    No shuffle: each row is counted where it is read."""
    shared = docs.sparkSession.sparkContext.broadcast(compile_tokenizer(tokenizer_path))

    def run(batches):
        if tokenizer_path not in _counters:
            _counters[tokenizer_path] = Counter(shared.value)
        counter = _counters[tokenizer_path]
        for batch in batches:
            size, tokens = [], []
            for _, _, data, offsets in text_chunks(batch.column(1)):
                size.append(np.diff(offsets))
                tokens.append(counter.count_texts(data, offsets))
            size = np.concatenate(size) if size else np.zeros(0, np.int64)
            tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(tokens), pa.array(tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
