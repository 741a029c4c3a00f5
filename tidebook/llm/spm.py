"""SentencePiece encoding and decoding that keeps source offsets.

The text is normalised by the model's compiled character map, always taking the longest key that
starts at the current byte, and each byte of the result records the source byte it came from. The
normalised text is cut before each run of space signs that follows another character, where no merge
can cross, and the characters of each word are merged pair by pair in the order of the pieces' scores.
The pieces tile the normalised text, so their cumulated lengths, projected through the record, give
every piece its span of original bytes. Reading the model, encoding and decoding are done here; the
sentencepiece library is what the tests compare with.

Defined results: a null text encodes as the empty one (begin and end ids only); spans of begin and
end ids are empty; a piece that comes from a dummy prefix alone has an empty span at 0; repeated rows
each get a row; an empty table gives an empty result; very long texts are one value each, and a word
without spaces costs n log n of its length; other columns are kept by encode_spans() and encoded(), but
those named like a new one (ids, starts, ends, n_tokens, decoded_sha256) are replaced.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

BATCH = 200  # texts a step of a Python worker
SHORT = 64  # characters of a word that is merged by scanning and may be held
BULK = 1 << 14  # words that are merged at once
HELD = 1 << 18  # words a worker holds in each of two generations
INF = float("inf")
SPACE = "▁".encode()  # the sign that stands for a space inside pieces
BPE = 2  # the model type of byte pair encoding
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the model format


def _fields(buf: bytes):
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            byte = buf[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(buf):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            size = varint()
            value, at = buf[at : at + size], at + size
        else:
            size = 8 if kind == 1 else 4
            value, at = buf[at : at + size], at + size
        yield tag >> 3, value


class CharsMap:
    """Longest-prefix lookup in a compiled character map: a double-array trie and its replacements."""

    def __init__(self, blob: bytes):
        self.empty = len(blob) < 4
        if not self.empty:
            (size,) = struct.unpack_from("<I", blob)
            self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
            self.text = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(length of the longest key at data[at:], its replacement), or None."""
        if self.empty:
            return None
        node, best = self._child(self.units[0], 0), None
        for i in range(at, len(data)):
            byte = data[i]
            node ^= byte
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != byte:
                break
            node = self._child(unit, node)
            if unit >> 8 & 1:
                best = (i + 1 - at, self.units[node] & 0x7FFFFFFF)
        if best is None:
            return None
        return best[0], self.text[best[1] : self.text.index(0, best[1])]

    @staticmethod
    def _child(unit: int, node: int) -> int:
        return node ^ ((unit >> 10) << ((unit & 512) >> 6))


@dataclass
class Encoded:
    """Ids with begin and end, and each id's span of original UTF-8 bytes."""

    ids: np.ndarray
    start: np.ndarray
    end: np.ndarray


class Codec:
    """One model: normaliser, encoder and decoder, read from the bytes of its file."""

    def __init__(self, blob: bytes):
        pieces, trainer, spec = [], {}, b""
        for number, value in _fields(blob):
            if number == 1:
                pieces.append(dict(_fields(value)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                spec = value
        if trainer.get(3, 1) != BPE:
            raise ValueError("only models of type BPE are supported")
        norm = dict(_fields(spec))
        self.map = CharsMap(norm.get(2, b""))
        self.dummy, self.trim, self.escape = (bool(norm.get(k, 1)) for k in (3, 4, 5))
        self.bos, self.eos = trainer.get(41, 1), trainer.get(42, 2)
        kinds = [p.get(3, NORMAL) for p in pieces]
        self.kind = np.array(kinds)
        self.user = [p[1] for p in pieces if p.get(3) == USER]
        self.size = np.array([0 if k == CONTROL else 1 if k == BYTE else len(p[1]) for k, p in zip(kinds, pieces)], dtype=np.int64)
        names = [p[1].decode("utf-8") for p in pieces]
        self.id = {n: i for i, (n, k) in enumerate(zip(names, kinds)) if k not in (CONTROL, UNKNOWN, BYTE)}
        self.unused = {n for n, k in zip(names, kinds) if k == UNUSED}
        # What is merged first: the highest score, so the lowest rank.
        self.rank = {n: -struct.unpack("<f", pieces[i].get(2, bytes(4)))[0] for n, i in self.id.items()}
        self.byte = {int(n[3:5], 16): i for i, (n, k) in enumerate(zip(names, kinds)) if k == BYTE}
        self.unknown = kinds.index(UNKNOWN)
        self.controls = {i for i, k in enumerate(kinds) if k == CONTROL}
        surface = trainer.get(44, " \u2047 ".encode()).decode("utf-8")
        gap = SPACE.decode()
        plain = [b"" if k == CONTROL else surface.encode() if k == UNKNOWN else bytes([int(n[3:5], 16)]) if k == BYTE else n.replace(gap, " ").encode() for n, k in zip(names, kinds)]
        self.plain = plain
        self.leads = [k not in (CONTROL, UNKNOWN, BYTE) and n.startswith(gap) for n, k in zip(names, kinds)]
        # No piece holds a space sign after another character: then merges never cross the start of a word.
        whole = any(gap in n.lstrip(gap) for n in self.id)
        self.split = re.compile(r"(?s).+" if whole else f"(?s){gap}+[^{gap}]*|[^{gap}]+")
        self.frozen = re.compile("(" + "|".join(re.escape(u.decode()) for u in sorted(self.user, key=len, reverse=True)) + ")") if self.user else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # Characters that are no pieces are symbols of their own, which join with nothing.
        self.of_char = np.arange(0x110000) + len(kinds)
        self.wide = 0x110000 + len(kinds)
        pairs = {}
        for name, i in self.id.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
            for cut in range(1, len(name)):
                if name[:cut] in self.id and name[cut:] in self.id:
                    pairs[self.id[name[:cut]] * self.wide + self.id[name[cut:]]] = (self.rank[name], i)
        self.pair_key = np.array(sorted(pairs) or [-1], dtype=np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in sorted(pairs)] or [INF], dtype=np.float32)
        self.pair_id = np.array([pairs[k][1] for k in sorted(pairs)] or [0], dtype=np.int64)

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """The normalised UTF-8 and, for each of its bytes and its end, the original byte offset."""
        data = text.encode("utf-8")
        space = SPACE if self.escape else b" "
        if not data:
            return b"", np.zeros(1, dtype=np.int64)
        if self.map.empty and not self.trim and not self.user:
            # Every character is its own longest prefix; only spaces change.
            raw = np.frombuffer(data, np.uint8)
            lead = space if self.dummy else b""
            at = np.repeat(np.arange(len(raw)), np.where(raw == 32, len(space), 1))
            return lead + data.replace(b" ", space), np.concatenate([np.zeros(len(lead), np.int64), at, [len(raw)]])
        out, at = bytearray(), []
        i, blank = 0, True
        if self.dummy:
            out += space
            at += [0] * len(space)
        while i < len(data):
            used, new = self._prefix(data, i)
            if self.trim and blank:
                kept = new.lstrip(b" ")
                new, skipped = kept, len(new) - len(kept)
                if not kept and skipped:
                    i += used
                    continue
            if new:
                new = new.replace(b" ", space)
                out += new
                at += [i] * len(new)
                blank = self.trim and new.endswith(space)
            i += used
        if self.trim:
            first = len(space) if self.dummy else 0
            while len(out) > first and out.endswith(space):
                del out[-len(space) :], at[-len(space) :]
            if len(out) <= first:
                return b"", np.zeros(1, dtype=np.int64)
        return bytes(out), np.array([*at, len(data)], dtype=np.int64)

    def _prefix(self, data: bytes, i: int) -> tuple[int, bytes]:
        """(bytes used, what they become) for the longest user symbol, map key or single character at i."""
        named = max((u for u in self.user if data.startswith(u, i)), key=len, default=None)
        if named:
            return len(named), named
        found = self.map.longest(data, i)
        if found:
            return found
        lead = data[i]
        used = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return used, data[i : i + used]

    def encode(self, texts: list[str]) -> list[Encoded]:
        """Encodings without sampling, between begin and end ids."""
        norms = [self.normalise(t) for t in texts]
        parts = [self._words(norm.decode("utf-8")) for norm, _ in norms]
        asked = set().union(*parts)
        known = self._known(asked)
        out = [self._one(norm, at, words, known) for (norm, at), words in zip(norms, parts)]
        for word in asked:
            if len(word) > SHORT:
                del known[word]
        return out

    def _words(self, plain: str) -> list[str]:
        """The parts of a normalised text over whose ends no merge goes."""
        if not self.frozen:
            return self.split.findall(plain)
        return [w for k, part in enumerate(self.frozen.split(plain)) for w in ([part] if k % 2 else self.split.findall(part))]

    def _known(self, asked: set[str]) -> dict[str, bytes]:
        """The ids of words, as packed 32-bit numbers: those held from before, and what is asked for now."""
        if len(self.young) >= HELD:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        new = asked.difference(young)
        again = [w for w in new if w in old]
        young.update(zip(again, map(old.__getitem__, again)))
        new.difference_update(again)
        plain = [w for w in new if len(w) <= SHORT] if not self.unused and not self.frozen else []
        plain.sort(key=len)
        for at in range(0, len(plain), BULK):
            self._learn(plain[at : at + BULK], young)
        for word in new:
            if word not in young:
                ids = [self.id[word]] if self.frozen and self.frozen.fullmatch(word) else self._ids(self._merged(word))
                young[word] = np.array(ids, dtype=np.int32).tobytes()
        return young

    def _learn(self, words: list[str], into: dict) -> None:
        """Merge many words at once, each step joining the best pair of every word."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        size = np.fromiter(map(len, words), np.int64, len(words))
        n, wide = len(words), int(size.max())
        part = np.full((n, wide + 1), -1, dtype=np.int64)
        part[:, :wide][np.arange(wide) < size[:, None]] = self.of_char[code]
        after = np.tile(np.arange(1, wide + 2), (n, 1))
        before = np.tile(np.arange(-1, wide), (n, 1))
        cost, made = self._pairs(part[:, :-1], part[:, 1:])
        rows = np.arange(n)
        while len(rows):
            near = cost[rows]
            i = near.argmin(axis=1)
            ok = near[np.arange(len(rows)), i] < INF
            rows, i = rows[ok], i[ok]
            j = after[rows, i]
            k = after[rows, j]
            part[rows, i] = made[rows, i]
            part[rows, j] = -2
            cost[rows[j < wide], j[j < wide]] = INF
            after[rows, i] = k
            before[rows, k] = i
            cost[rows, i], made[rows, i] = self._pairs(part[rows, i], part[rows, k])
            h = before[rows, i]
            some = h >= 0
            r, h, i = rows[some], h[some], i[some]
            cost[r, h], made[r, h] = self._pairs(part[r, h], part[r, i])
        left = part[:, :wide]
        flat = left[left >= 0]
        stop = np.cumsum((left >= 0).sum(axis=1))
        odd = np.flatnonzero(flat >= len(self.kind))
        odd = set(np.searchsorted(stop, odd, side="right").tolist())
        raw, start = flat.astype(np.int32).tobytes(), 0
        for k, (word, end) in enumerate(zip(words, (4 * stop).tolist())):
            into[word] = raw[start:end]
            if k in odd:
                into[word] = np.array([x for i in flat[start // 4 : end // 4].tolist() for x in self._ids_of(i)], dtype=np.int32).tobytes()
            start = end

    def _ids_of(self, symbol: int) -> list[int]:
        """A piece's id, or what a character that is no piece becomes."""
        return [symbol] if symbol < len(self.kind) else self._ids([chr(symbol - len(self.kind))])

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For pairs of pieces the rank of what they join to, INF if nothing, and its id."""
        key = a * self.wide + b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        hit = (self.pair_key[at] == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self.pair_rank[at], np.float32(INF)), self.pair_id[at]

    def _one(self, norm: bytes, at: np.ndarray, words: list[str], known: dict) -> Encoded:
        ids = np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32)
        got = np.concatenate([[self.bos], ids, [self.eos]])
        size = self.size[got]
        if not self.byte and (ids == self.unknown).any():
            got, size = self._unknown(got, norm)
        edge = np.concatenate([[0], np.cumsum(size)])
        return Encoded(got, at[edge[:-1]], at[edge[1:]])

    def _ids(self, parts: list[str]) -> list[int]:
        out = []
        for p in parts:
            i = self.id.get(p)
            if i is not None:
                out.append(i)
            elif self.byte:
                out += [self.byte[b] for b in p.encode("utf-8")]
            else:
                out.append(self.unknown)
        return out

    def _merged(self, word: str) -> list[str]:
        """Characters joined pair by pair, always the pair of best score, of equal ones the leftmost."""
        parts, made = list(word), {}
        get = self.rank.get
        if len(parts) <= SHORT:
            cost = [get(a + b, INF) for a, b in zip(word, word[1:])]
            while cost:
                best = min(cost)
                if best == INF:
                    break
                i = cost.index(best)
                both = parts[i] + parts.pop(i + 1)
                if self.unused:
                    made[both] = (parts[i], both[len(parts[i]) :])
                parts[i] = both
                del cost[i]
                if i:
                    cost[i - 1] = get(parts[i - 1] + both, INF)
                if i < len(cost):
                    cost[i] = get(both + parts[i + 1], INF)
        else:
            parts = self._merged_long(parts, made)
        if self.unused:
            parts = [x for p in parts for x in self._unmade(p, made)]
        return parts

    def _merged_long(self, parts: list[str], made: dict) -> list[str]:
        """The same by a heap and a linked list, for words of any length."""
        n, rank = len(parts), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(c, i, 2) for i in range(n - 1) if (c := rank.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i] if parts[i] else n
            if j >= n or len(parts[i]) + len(parts[j]) != size:
                continue
            both = parts[i] + parts[j]
            made[both] = (parts[i], parts[j])
            parts[i], parts[j] = both, ""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (c := rank.get(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (c, a, len(parts[a]) + len(parts[b])))
        return [p for p in parts if p]

    def _unmade(self, part: str, made: dict) -> list[str]:
        """A part that no id may be given to, as the parts it was made of."""
        if part not in self.unused or part not in made:
            return [part]
        return [x for p in made[part] for x in self._unmade(p, made)]

    def _unknown(self, ids: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes where unknown characters that follow each other share one id."""
        size, at = self.size[ids], 0
        for k, i in enumerate(ids.tolist()):
            if i == self.unknown:
                lead = data[at]
                size[k] = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            at += int(size[k])
        first = np.flatnonzero(np.concatenate([[True], (ids[1:] != self.unknown) | (ids[:-1] != self.unknown)]))
        return ids[first], np.add.reduceat(size, first)

    def decode(self, ids) -> str:
        """The text of ids: the first piece's space sign goes if the model adds one, bytes that are no UTF-8 become U+FFFD."""
        plain, ids = self.plain, np.asarray(ids).tolist()
        if not self.controls.isdisjoint(ids[1:-1]):
            # Bytes on both sides of a begin or end id make no character together.
            return "".join(self._text(run, first) for first, run in self._runs(ids))
        return self._text(ids, True)

    def _runs(self, ids: list[int]):
        """(whether no text precedes, ids) of the runs between control ids."""
        run, first = [], True
        for i in (*ids, None):
            if i is None or i in self.controls:
                yield first, run
                first, run = first and not any(self.plain[x] for x in run), []
            else:
                run.append(i)

    def _text(self, ids: list[int], first: bool) -> str:
        plain = self.plain
        raw = b"".join([plain[i] for i in ids])
        if first and (self.dummy or self.trim):
            lead = next((i for i in ids if plain[i]), None)
            if lead is not None and self.leads[lead]:
                raw = raw[len(plain[lead]) - len(plain[lead].lstrip(b" ")) if self.trim else 1 :]
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return _decoded(raw)


def _decoded(raw: bytes) -> str:
    """UTF-8 read as far as possible, each byte that starts no character as U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode("utf-8"))
            break
        except UnicodeDecodeError as bad:
            out.append(raw[at : at + bad.start].decode("utf-8") + "\ufffd")
            at += bad.start + 1
    return "".join(out)


@functools.lru_cache(maxsize=2)
def codec(blob: bytes) -> Codec:
    """The codec of a model, built once in each Python worker."""
    return Codec(blob)


def load(path: str) -> bytes:
    """The bytes of a model file (about half a MB), read where the query is planned."""
    with open(path, "rb") as f:
        return f.read()


def encode_spans(docs: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """docs with ids array<int>, starts and ends array<long>: byte spans in the original UTF-8."""
    docs = docs.drop("ids", "starts", "ends")
    at = docs.columns.index(text_col)
    schema = StructType(list(docs.schema.fields))
    for name, kind in (("ids", ArrayType(IntegerType())), ("starts", ArrayType(LongType())), ("ends", ArrayType(LongType()))):
        schema = schema.add(name, kind)

    def run(batches):
        c = codec(model)
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                part = b.slice(lo, BATCH)
                got = c.encode([t or "" for t in part.column(at).to_pylist()])
                new = [
                    pa.array([g.ids.astype(np.int32) for g in got], pa.list_(pa.int32())),
                    pa.array([g.start for g in got], pa.list_(pa.int64())),
                    pa.array([g.end for g in got], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, "ids", "starts", "ends"])

    return docs.mapInArrow(run, schema)


def encoded(docs: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """docs without text_col, with ids array<int>, n_tokens and decoded_sha256, in one pass over the texts."""
    docs = docs.drop("ids", "n_tokens", "decoded_sha256")
    at = docs.columns.index(text_col)
    kept = [i for i in range(len(docs.columns)) if i != at]
    schema = StructType([docs.schema.fields[i] for i in kept])
    for name, kind in (("ids", ArrayType(IntegerType())), ("n_tokens", LongType()), ("decoded_sha256", StringType())):
        schema = schema.add(name, kind)

    def run(batches):
        c = codec(model)
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                part = b.slice(lo, BATCH)
                got = c.encode([t or "" for t in part.column(at).to_pylist()])
                text = [hashlib.sha256(c.decode(g.ids).encode("utf-8")).hexdigest() for g in got]
                new = [pa.array([g.ids.astype(np.int32) for g in got], pa.list_(pa.int32())), pa.array([len(g.ids) for g in got], pa.int64()), pa.array(text, pa.string())]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in kept], *new], names=schema.names)

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256) for every row, in one pass over the texts."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"]

    def run(batches):
        c = codec(model)
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                part = b.slice(lo, BATCH)
                size, ids, text, span = [], [], [], []
                for g in c.encode([t or "" for t in part.column(1).to_pylist()]):
                    size.append(len(g.ids))
                    ids.append(hashlib.sha256(g.ids.astype("<u4").tobytes()).hexdigest())
                    text.append(hashlib.sha256(c.decode(g.ids).encode("utf-8")).hexdigest())
                    span.append(hashlib.sha256(np.stack([g.start, g.end], 1).astype("<u8").tobytes()).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size, pa.int64()), pa.array(ids), pa.array(text), pa.array(span)], names=names)

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_sha256 string")
