"""BPE encoding and decoding with a contiguous array of parts and adjacent ranks.

A short word is held as its part boundaries (here: the ids of its parts) and
the merge rank of every two neighbours.  The smallest rank is scanned for, its
boundary deleted, and the two ranks beside it refreshed, until no neighbours
merge.  All new words of one byte length are one matrix, a word per row, so
each scan runs over the rows of a batch at once; since every open row loses
exactly one boundary a round, rows stay contiguous.  Rare long words use a
heap with the same order of merges (lowest rank, then leftmost).

Words already encoded stay in a bounded cache of the Python worker.  Nothing is
shuffled: a document goes in, its ids and its decoded text come out.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from .columns import id_and_text, runs_of
from .tokenizer_files import broadcast_file, per_worker

SHORT = 128
# Units whose ids a worker holds, and their longest in characters.
HELD = 250_000
HELD_CHARS = 64
NO_RANK = np.int64(1 << 40)
# Long texts are encoded in parts of about so many characters, cut at spaces.
PIECE = 1_000_000

# Letters, digits and marks below U+0250 that lower-case to one letter in place.
_SIMPLE = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-įı-ňŊ-ǃǍ-ǯǴ-ɏ]*\Z")


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, extra = {}, 0
    for b in range(256):
        if b in own:
            table[b] = chr(b)
        else:
            table[b] = chr(256 + extra)
            extra += 1
    return [table[b] for b in range(256)]


class Merges:
    """Vocabulary and merges of one BPE file with word ends, as arrays."""

    def __init__(self, model: dict) -> None:
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        chars = byte_characters()
        self.inner = np.array([vocab[c] for c in chars], dtype=np.int64)
        self.final = np.array([vocab[c + suffix] for c in chars], dtype=np.int64)
        pairs = [(m if isinstance(m, list) else m.split(" ", 1)) for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of = keys[order], order.astype(np.int64)
        self.by_pair = dict(zip(keys.tolist(), range(len(pairs)), strict=True))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each two neighbours, ``NO_RANK`` where they do not merge."""
        key = left << 20 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.rank_of[at], NO_RANK)

    def encode_rows(self, words: list[bytes], out: dict[bytes, bytes]) -> None:
        """Ids (little-endian 32 bit) of words that all have the same byte length."""
        n = len(words[0])
        raw = np.frombuffer(b"".join(words), dtype=np.uint8).reshape(-1, n)
        parts = self.inner[raw]
        parts[:, -1] = self.final[raw[:, -1]]
        row = np.arange(len(words))
        ranks = self.ranks(parts[:, :-1], parts[:, 1:])
        while len(row):
            width = parts.shape[1]
            if width > 1:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(row)), at]
                done = best == NO_RANK
            else:
                done = np.ones(len(row), dtype=bool)
            if done.any():
                flat, size = parts[done].astype("<u4").tobytes(), 4 * width
                for k, r in enumerate(row[done].tolist()):
                    out[words[r]] = flat[k * size:(k + 1) * size]
                if width == 1 or done.all():
                    return
                keep = ~done
                parts, ranks, row, at, best = parts[keep], ranks[keep], row[keep], at[keep], best[keep]
            line = np.arange(len(row))
            parts[line, at] = self.merged[best]
            # Delete the boundary behind the merged part.
            columns = np.arange(width - 1)[None, :]
            parts = np.take_along_axis(parts, columns + (columns > at[:, None]), axis=1)
            if width > 2:
                columns = columns[:, :-1]
                ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
                # Refresh the ranks on either side of it.
                right = np.flatnonzero(at < width - 2)
                p = at[right]
                ranks[right, p] = self.ranks(parts[right, p], parts[right, p + 1])
                left = np.flatnonzero(at > 0)
                p = at[left]
                ranks[left, p - 1] = self.ranks(parts[left, p - 1], parts[left, p])
            else:
                ranks = np.empty((len(row), 0), dtype=np.int64)

    def encode_long(self, word: bytes) -> bytes:
        """The same merges for one long word, by a heap over a linked list."""
        ids = self.inner[np.frombuffer(word, dtype=np.uint8)].tolist()
        ids[-1] = int(self.final[word[-1]])
        n = len(ids)
        after, before, alive = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (r := self.by_pair.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j] = int(self.merged[r]), False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and (right := after[left]) >= 0:
                    rank = self.by_pair.get(ids[left] << 20 | ids[right])
                    if rank is not None:
                        heapq.heappush(heap, (rank, left, ids[left], ids[right]))
        return np.array([x for x, live in zip(ids, alive, strict=True) if live], dtype="<u4").tobytes()

    def encode(self, words: set[bytes]) -> dict[bytes, bytes]:
        out: dict[bytes, bytes] = {}
        by_length: dict[int, list[bytes]] = {}
        for w in words:
            if len(w) > SHORT:
                out[w] = self.encode_long(w)
            else:
                by_length.setdefault(len(w), []).append(w)
        for same in by_length.values():
            self.encode_rows(same, out)
        return out


class Codec:
    """Text to ids and ids to text as one tokenizer file says; one per Python worker.

    Fits files of lower-casing word-end BPE: the normaliser composes, turns white
    space into a space and lower-cases, and the pattern drops white space, so a
    text may be cut at any ASCII white space.
    """

    def __init__(self, content: str) -> None:
        from tokenizers import Tokenizer

        spec = json.loads(content)
        self.merges = Merges(spec["model"])
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        library = Tokenizer.from_str(content)
        # The file's own normaliser and splitter decide about characters beyond the simple ones.
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.byte_of = {c: b for b, c in enumerate(byte_characters())}
        names = {i: t for t, i in spec["model"]["vocab"].items()} | {i: t for t, i in self.specials.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.held: dict[str, bytes] = {}

    def words(self, unit: str) -> list[bytes | int]:
        """Pre-tokens of a unit without white space, in bytes; an int is a special id."""
        if self.special and self.special.search(unit):
            return [x for part in self.special.split(unit) if part
                    for x in ([self.specials[part]] if part in self.specials else self.words(part))]
        if _SIMPLE.match(unit):
            return [w.encode() for w in self.pattern.findall(unit.lower())]
        text = self.normalizer.normalize_str(unit)
        return [bytes(map(self.byte_of.__getitem__, w)) for w, _ in self.splitter.pre_tokenize_str(text)]

    def learn(self, units: set[str]) -> dict[str, bytes]:
        """The ids of all units; those of short ones stay in the cache."""
        missing = units - self.held.keys()
        if len(self.held) + len(missing) > HELD:
            held = self.held
            self.held = {u: held[u] for u in units & held.keys()}
        cut = {u: self.words(u) for u in missing}
        coded = self.merges.encode({w for ws in cut.values() for w in ws if isinstance(w, bytes)})
        long = {}
        for u, ws in cut.items():
            ids = b"".join(coded[w] if isinstance(w, bytes) else w.to_bytes(4, "little") for w in ws)
            (self.held if len(u) <= HELD_CHARS else long)[u] = ids
        return {u: self.held[u] for u in units - long.keys()} | long if long else self.held

    @staticmethod
    def units(text: str) -> list[str]:
        for space in "\n\t\r\x0b\x0c":
            text = text.replace(space, " ")
        return text.split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.units(t) for t in texts]
        every: set[str] = set()
        for c in cut:
            every.update(c)
        get = self.learn(every).__getitem__
        return [b"".join(map(get, c)) for c in cut]

    def decode(self, ids: bytes) -> str:
        """The file names no decoder, so tokens are joined by a space."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    def digests(self, text: str) -> tuple[int, str, str]:
        """Token count and digests of ids and decoded text, part by part."""
        ids_hash, text_hash, n, at = hashlib.sha256(), hashlib.sha256(), 0, 0
        while at < len(text):
            end = text.find(" ", at + PIECE)
            end = len(text) if end < 0 else end
            (ids,) = self.encode([text[at:end]])
            if ids:
                ids_hash.update(ids)
                text_hash.update((" " if n else "").encode() + self.decode(ids).encode())
                n += len(ids) // 4
            at = end
        return n, ids_hash.hexdigest(), text_hash.hexdigest()


def _rows(codec: Codec, texts: list[str], full: bool) -> Iterator[tuple]:
    for start, end in runs_of(texts):
        part = texts[start:end]
        if not full and any(len(t) > PIECE for t in part):
            yield from (codec.digests(t) for t in part)
            continue
        for ids in codec.encode(part):
            decoded = codec.decode(ids)
            if full:
                yield np.frombuffer(ids, dtype="<u4").astype(np.int64), decoded
            else:
                yield len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string())])
CODES = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("decoded", pa.string())])


def _coder(shared: Broadcast, full: bool):
    schema = CODES if full else DIGESTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = per_worker(Codec, shared)
        for batch in batches:
            rows = list(_rows(codec, batch.column(1).to_pylist(), full))
            columns = list(zip(*rows, strict=True)) or [()] * (len(schema) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True))],
                schema=schema)
    return run


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of long) and decoded text of every document.

    Ids are those of the file's library without begin and end tokens; special
    strings inside a text are special tokens.  Null and empty texts: no ids, an
    empty text.  Repeated rows give repeated results; other columns are not read.
    """
    shared = broadcast_file(docs.sparkSession, tokenizer_path)
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _coder(shared, True), "doc_id long, ids array<long>, decoded string")


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and SHA-256 digests of the ids and of the decoded text (see :func:`encode`)."""
    shared = broadcast_file(docs.sparkSession, tokenizer_path)
    return id_and_text(docs, id_col, text_col).mapInArrow(
        _coder(shared, False), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
