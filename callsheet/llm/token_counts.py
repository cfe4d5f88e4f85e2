"""Token counts by deterministic transducers whose transitions carry emitted-token counts.

Two machines are compiled from a byte-level BPE vocabulary file.

* The splitter (12 states over 12 character classes) marks where pre-tokens begin.
  Text is cut into chunks of fixed length; each chunk becomes a map from entry state to
  exit state, the maps are composed by a parallel prefix scan, and with its entry state
  known every chunk marks its pre-tokens on its own.
* The merger reads the bytes of all pre-tokens at once, one step a byte. Its state holds
  what decides the merges still to come: the open vocabulary prefixes and the token
  before each. A transition carries the change of the token count. Transitions are
  compiled when first met; how many there are depends on the vocabulary, not on the
  amount of text.

That the merged tokens of a text can be found from left to right rests on a property of
byte-pair merges: a sequence of tokens is the merge result exactly if each neighbouring
pair is."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import blobs, slabs

#: Character classes.
LETTER, DIGIT, OTHER, SPACE, BLANK, QUOTE, STMD, R, V, L, E, END = range(12)
#: States: begin, letters, digits, others, quote, quote+r, quote+v, quote+l, one space,
#: more blanks then space, one other blank, more blanks then other blank.
BEGIN, IN_LETTERS, IN_DIGITS, IN_OTHERS, AFTER_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, SPACE_1, SPACE_N, BLANK_1, BLANK_N = range(12)
#: Marks: a pre-token begins here; one begins at the character before.
HERE, BEFORE = 1, 2
LETTERS = (LETTER, STMD, R, V, L, E)
CHUNK = 512
#: Pre-tokens of more bytes are walked on their own.
LONG = 256


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks by (state, class) of the pre-token pattern."""
    nxt, out = np.zeros((12, 12), np.uint8), np.zeros((12, 12), np.uint8)
    fresh = {DIGIT: IN_DIGITS, OTHER: IN_OTHERS, SPACE: SPACE_1, BLANK: BLANK_1, QUOTE: AFTER_QUOTE, END: BEGIN} | {c: IN_LETTERS for c in LETTERS}
    for state in range(12):
        for c, to in fresh.items():
            nxt[state, c], out[state, c] = to, HERE

    def set_(state, classes, to, mark=0):
        for c in classes:
            nxt[state, c], out[state, c] = to, mark

    set_(IN_LETTERS, LETTERS, IN_LETTERS)
    set_(IN_DIGITS, [DIGIT], IN_DIGITS)
    set_(IN_OTHERS, [OTHER, QUOTE], IN_OTHERS)
    set_(AFTER_QUOTE, [OTHER, QUOTE], IN_OTHERS)
    set_(AFTER_QUOTE, [STMD], BEGIN)
    for c, held in ((R, QUOTE_R), (V, QUOTE_V), (L, QUOTE_L)):
        set_(AFTER_QUOTE, [c], held)
    for held, last in ((QUOTE_R, E), (QUOTE_V, E), (QUOTE_L, L)):
        out[held] |= BEFORE  # the letter after the quote was a word's first
        set_(held, LETTERS, IN_LETTERS, BEFORE)
        set_(held, [last], BEGIN)
    for state in (SPACE_1, SPACE_N, BLANK_1, BLANK_N):
        set_(state, [SPACE], SPACE_N)
        set_(state, [BLANK], BLANK_N)
    joins = {c: IN_LETTERS for c in LETTERS} | {DIGIT: IN_DIGITS, OTHER: IN_OTHERS, QUOTE: IN_OTHERS}
    for c, to in joins.items():
        set_(SPACE_1, [c], to)
        set_(SPACE_N, [c], to, BEFORE)
        out[BLANK_N, c] |= BEFORE
    return nxt, out


def _classes() -> np.ndarray:
    """Class of every code point."""
    kind = np.full(0x110000, OTHER, np.uint8)
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, c in ((r"\p{L}+", LETTER), (r"\p{N}+", DIGIT)):
        for m in regex.finditer(pattern, text):
            a, b = ord(text[m.start()]), ord(text[m.end() - 1])
            kind[a:b + 1] = c
    # The White_Space code points.
    kind[[9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = BLANK
    kind[ord(" ")], kind[ord("'")] = SPACE, QUOTE
    kind[[ord(c) for c in "stmd"]] = STMD
    for c, k in (("r", R), ("v", V), ("l", L), ("e", E)):
        kind[ord(c)] = k
    return kind


def scan(maps: np.ndarray) -> np.ndarray:
    """Composed maps of all chunks before each (identity first), by doubling steps."""
    n, states = maps.shape
    acc, step = maps.copy(), 1
    while step < n:
        later = np.take_along_axis(acc[step:], acc[:-step].astype(np.intp), axis=1)
        acc = np.concatenate([acc[:step], later])
        step *= 2
    return np.concatenate([np.arange(states, dtype=maps.dtype)[None], acc[:-1]]) if n else acc


class Splitter:
    def __init__(self):
        self.next, self.marks = (t.ravel() for t in _splitter())
        self.kinds = _classes()

    def starts(self, kinds: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """Positions where a pre-token begins."""
        n = len(kinds)
        rows = -(-n // chunk)
        grid = np.full(rows * chunk, END, np.uint8)
        grid[:n] = kinds
        grid = np.ascontiguousarray(grid.reshape(rows, chunk).T)
        maps = np.tile(np.arange(12, dtype=np.uint8)[:, None], (1, rows))
        for column in grid:
            maps = self.next[maps * np.uint8(12) + column]
        state = scan(np.ascontiguousarray(maps.T))[:, BEGIN]
        marks = np.empty_like(grid)
        for i, column in enumerate(grid):
            at = state * np.uint8(12) + column
            marks[i] = self.marks[at]
            state = self.next[at]
        marks = np.ascontiguousarray(marks.T).ravel()
        begin = marks & HERE != 0
        begin[:-1] |= marks[1:] & BEFORE != 0
        return np.flatnonzero(begin[:n])


def byte_letters() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable bytes stand
    for themselves, the others for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merger:
    """Lazily compiled transducer of the merges of one pre-token.

    Token texts are sequences of symbols: bytes, and with an end-of-word suffix the last
    byte of a pre-token is a symbol of its own (256 more)."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str = ""):
        letters = byte_letters()

        def symbols(token: str) -> str:
            last = bool(suffix) and token.endswith(suffix)
            body = [letters[c] for c in (token[:-len(suffix)] if last else token)]
            return "".join(map(chr, [*body[:-1], body[-1] + 256] if last else body))

        self.text, known = {}, {}
        for token, i in vocab.items():
            if token and all(c in letters for c in (token.removesuffix(suffix) if suffix else token)):
                self.text[i] = symbols(token)
                known[token] = i
        self.tokens = {t: i for i, t in self.text.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.ranks = {(known[a], known[b]): (r, known[a + b]) for r, (a, b) in enumerate(pairs)}
        self.length = np.zeros(max(self.text) + 1, np.int32)
        self.length[list(self.text)] = [len(t) for t in self.text.values()]
        self.prefixes = {t[:k] for t in self.tokens for k in range(len(t))}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        """Forget compiled transitions; they are compiled again when met."""
        self.ids = {("", ((0, -1, 0),)): 0}
        self.states = [("", ((0, -1, 0),))]
        self.bits, self.used = 18, 0
        self._empty()

    def _empty(self) -> None:
        self.keys = np.full(1 << self.bits, -1, np.int32)
        self.table, self.token = np.zeros(1 << self.bits, np.int32), np.zeros(1 << self.bits, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each transition (state * 512 + symbol), or -1."""
        at = ((keys.astype(np.uint32) * np.uint32(2654435769)) >> np.uint32(32 - self.bits)).astype(np.int64)
        found = self.keys[at]
        odd = np.flatnonzero(found != keys)
        while len(odd):  # the slots that follow, until the key or a free one
            free = found[odd] < 0
            at[odd[free]] = -1
            odd = odd[~free]
            at[odd] = (at[odd] + 1) & ((1 << self.bits) - 1)
            found[odd] = self.keys[at[odd]]
            odd = odd[found[odd] != keys[odd]]
        return at

    def keep(self, key: int, packed: int, token: int) -> int:
        if 4 * self.used > len(self.keys):
            old = self.keys, self.table, self.token
            self.bits, self.used = self.bits + 1, 0
            self._empty()
            for i in np.flatnonzero(old[0] >= 0):
                self.keep(*(int(x[i]) for x in old))
        at = (key * 2654435769 & 0xFFFFFFFF) >> (32 - self.bits)
        while self.keys[at] >= 0:
            at = (at + 1) & (len(self.keys) - 1)
        self.keys[at], self.table[at], self.token[at] = key, packed, token
        self.used += 1
        return at

    def merge(self, text: str) -> list[int]:
        """The merges themselves, lowest rank first; for short pieces."""
        ids = [self.tokens[c] for c in text]
        while len(ids) > 1:
            best = min((self.ranks[p] for p in zip(ids, ids[1:]) if p in self.ranks), default=None)
            if best is None:
                break
            out, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and self.ranks.get((ids[i], ids[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def follows(self, a: int, b: int) -> bool:
        """Whether token ``b`` may stand after ``a`` (-1: at the beginning)."""
        if a < 0:
            if b not in self.whole:
                self.whole[b] = self.merge(self.text[b]) == [b]
            return self.whole[b]
        if (a, b) not in self.pairs:
            if len(self.pairs) > 1 << 20:  # a memo, filled again when needed
                self.pairs.clear()
            self.pairs[a, b] = self.merge(self.text[a] + self.text[b]) == [a, b]
        return self.pairs[a, b]

    def compile(self, state: int, symbol: int) -> None:
        """Make one transition: next state, count change and the token that ends here.

        An open entry is (length since a token end, token that ended there, count there
        less the count here); the longest that completes an allowed token wins."""
        suffix, entries = self.states[state]
        more = suffix + chr(symbol)
        token, delta = None, 0
        for length, last, rel in entries:
            t = self.tokens.get(more[len(more) - length - 1:])
            if t is not None and self.follows(last, t):
                token, delta = t, rel + 1
                break
        if token is None:
            raise ValueError(f"the vocabulary has no token for symbol {symbol}")
        kept = [(length + 1, last, rel - delta) for length, last, rel in entries if more[len(more) - length - 1:] in self.prefixes]
        kept.append((0, token, 0))
        if not -32 <= delta < 32:
            raise ValueError("a transition changes the count by more than its table holds")
        key = (more[len(more) - kept[0][0]:], tuple(kept))
        to = self.ids.get(key)
        if to is None:
            to = self.ids[key] = len(self.states)
            self.states.append(key)
        self.keep(state * 512 + symbol, to * 64 + delta + 32, token)

    def steps(self, symbol_at, size: np.ndarray):
        """Step all pre-tokens of ``size`` (longest first) together; yields after each step
        how many are alive and the slots of their transitions."""
        if len(self.states) > 1 << 18:
            self.reset()
        alive = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), side="left")
        state = np.zeros(len(size), np.int32)
        for step, n in enumerate(alive):
            keys = state[:n] * 512 + symbol_at(step, n)
            slot = self.find(keys)
            missing = np.unique(keys[slot < 0])
            if len(missing):
                for m in missing.tolist():
                    self.compile(m >> 9, m & 511)
                slot = self.find(keys)
            state[:n] = self.table[slot] >> 6
            yield n, slot

    def walk(self, word: str) -> int:
        """Tokens of one pre-token by the same transitions, taken without keeping them: a long
        word without blanks meets hardly any of its states again."""
        tokens, prefixes, pairs, follows = self.tokens, self.prefixes, self.pairs, self.follows
        entries, token, count = [(0, -1, 0)], None, 0
        for end in range(1, len(word) + 1):
            token = None
            kept = []
            for entry in entries:  # the longest open prefix first
                start, last, before = entry
                piece = word[start:end]
                if token is None:
                    t = tokens.get(piece)
                    if t is not None:
                        good = pairs.get((last, t)) if last >= 0 else None
                        if good or (good is None and follows(last, t)):
                            token, count = t, before + 1
                if piece in prefixes:
                    kept.append(entry)
            if token is None:
                raise ValueError(f"the vocabulary has no token for symbol {word[end - 1]!r}")
            kept.append((end, token, count))
            entries = kept
        return count

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each pre-token (without suffix)."""
        long = np.flatnonzero(ends - starts > LONG)
        if len(long):
            out = np.zeros(len(starts), np.int32)
            short = np.flatnonzero(ends - starts <= LONG)
            out[short] = self.counts(data, starts[short], ends[short])
            out[long] = [self.walk(data[starts[i]:ends[i]].tobytes().decode("latin-1")) for i in long]
            return out
        size = (ends - starts).astype(np.int32)
        order = np.argsort(-size, kind="stable")
        at, total = starts[order], np.zeros(len(size), np.int32)
        for n, slot in self.steps(lambda step, n: data[at[:n] + step], size[order]):
            total[:n] += (self.table[slot] & 63) - 32
        out = np.empty_like(total)
        out[order] = total
        return out

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pre-tokens one after another, and how many each has; the last
        byte of each is read as an end-of-word symbol."""
        size = (ends - starts).astype(np.int32)
        order = np.argsort(-size, kind="stable")
        at, long = starts[order], size[order]
        ended, total = np.zeros(len(data), np.int32), np.zeros(len(size), np.int32)
        step = 0
        for n, slot in self.steps(lambda step, n: data[at[:n] + step] + np.where(long[:n] == step + 1, 256, 0), long):
            ended[at[:n] + step] = self.token[slot]
            total[:n] += (self.table[slot] & 63) - 32
            step += 1
        counts = np.empty_like(total)
        counts[order] = total
        # From the last byte of each back, token by token.
        put = np.cumsum(counts, dtype=np.int64)
        ids = np.zeros(int(put[-1]) if len(put) else 0, np.uint32)
        place, where = ends - 1, put - 1
        while len(place):
            token = ended[place]
            ids[where] = token
            place, where = place - self.length[token], where - 1
            open_ = place >= starts
            place, where, starts = place[open_], where[open_], starts[open_]
        return ids, counts


class TokenCounter:
    """Counts as the tokenizer library gives them for a byte-level BPE file without
    normaliser; special strings inside a text count as one token."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec["pre_tokenizer"]
        if spec["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before.get("use_regex", True):
            raise ValueError("only byte-level files with the usual pattern and no normaliser can be compiled")
        self.splitter = Splitter()
        self.merger = Merger(spec["model"]["vocab"], spec["model"]["merges"])
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def count(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        for first, last in slabs(texts, 2 << 20):
            out[first:last] = self._slab([t.decode("utf-8", "replace") for t in texts[first:last]])
        return out

    def _slab(self, texts: list[str]) -> np.ndarray:
        pieces, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            parts = self.special.split(t) if self.special and "<" in t else [t]
            extra[i] = len(parts) - 1
            pieces += parts
            owner += [i] * len(parts)
        line = "\0".join(pieces) + "\0"
        points = np.frombuffer(line.encode("utf-32-le"), dtype="<u4")
        kinds = self.splitter.kinds[points]
        stops = np.cumsum([len(p) + 1 for p in pieces]) - 1
        kinds[stops] = END
        begin = self.splitter.starts(kinds)
        stop = np.append(begin[1:], len(points))
        real = kinds[begin] != END
        begin, stop = begin[real], stop[real]
        of = np.array(owner, dtype=np.int64)[np.searchsorted(stops, begin)]
        data = np.frombuffer(line.encode(), dtype=np.uint8)
        if len(data) != len(points):
            width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000).astype(np.int64)
            where = np.concatenate([[0], np.cumsum(width)])
            begin, stop = where[begin], where[stop]
        counts = self.merger.counts(data, begin, stop)
        return extra + np.bincount(of, weights=counts, minlength=len(texts)).astype(np.int64)


_COUNTERS: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """One compiled counter per worker process and file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    Reads ``doc_id`` and ``text``; whole texts, no special tokens added. Null texts count
    as empty: 0 bytes, 0 tokens. Rows repeated with one id and null ids stay rows. An empty
    table gives an empty result. ``path`` is a vocabulary file found on every executor."""
    def run(batches):
        machine = counter(path)
        for b in batches:
            texts = blobs(b.column("text"))
            n = machine.count(texts)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.array([len(t) for t in texts], np.int64)), pa.array(n), pa.array(n > limit)],
                                             names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
