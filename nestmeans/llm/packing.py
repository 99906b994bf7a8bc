"""Packing by lexical retrieval: documents that share rare tokens fill a training window together.

1. Texts are tokenized once, where they are read, and the ids are stored. The parts of a text between white space
   are independent of each other for a tokenizer that drops it, so results equal those of whole texts: the different
   ones of about 8 MB of text are found first, and of their letters, digits and punctuation only words not seen before
   are tokenized. A run of letters needs only the tokenizer's model, without its rules. Every task counts in how many of its
   documents a token occurs; the counts of all tasks are added up (one row per token of the vocabulary).
2. Documents are dealt to shards by content, whichever file they stand in: each gets ``DEAL`` min-hashes of its
   tokens, drawn with the fourth power of the IDF over all documents as weight, so two documents agree in one about as often as
   their rare tokens overlap. A range sort by them puts such documents side by side; its last key is the
   row, so a group of equal documents of any size spreads over tasks.
3. Each task cuts its sorted rows into shards of about ``shard_tokens`` tokens, a bound that does not grow with
   the data, and builds a BM25 inverted index over the token ids of each shard. Documents are taken as
   seeds in order; the windows a seed fills alone come first, and its rest begins a window that unused
   neighbours fill in the order of their BM25 score (ties: row order), then any other unused
   documents of the shard. The document that no longer fits is cut: its head completes the window
   and its tail stays unused. So every window is full but the shard's last, and that one is cut into
   powers of two, which need no padding.

Defined cases: NULL and empty texts consist of the end token; repeated rows and NULL ids are packed like
others; a text longer than a window is cut; equal min-hashes and scores go by row order; columns besides id and text,
whatever their names, are not read; zero rows give zero rows. ``sequence_id`` holds the task and the number of the
window in it.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestmeans.llm.words import mix, text_offsets
from nestmeans.scratch import materialize

WINDOW = 4096
END_TOKEN = 2
SHARD_TOKENS = 1_000_000
K1, B = 1.2, 0.75
CACHED_WORDS = 600_000
DEAL = 4
TASK_SHARDS = 4  # shards a task packs, as long as that takes no more than MAX_TASKS tasks
MAX_TASKS = 20_000
PIECE = 8 << 20  # bytes of text whose words are looked up together
TOKENIZER = "word_bpe_49k.json"
# Classes of bytes, after lower-casing: letters, digits, ASCII punctuation; the apostrophe and all other bytes are in none.
_LETTER, _DIGIT, _MARK = 1, 2, 3
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = _MARK
_CLASS[ord("A"):ord("Z") + 1] = _CLASS[ord("'")] = 0
_CLASS[ord("a"):ord("z") + 1] = _LETTER
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
# Letters of two bytes that stay one letter when normalized; the lower case of U+0130 has a combining dot.
LATIN = [chr(c) for c in range(0xC0, 0x250) if c not in (0xD7, 0xF7, 0x130)]
_LATIN = np.zeros(1 << 16, bool)
_LATIN[[int.from_bytes(c.encode(), "big") for c in LATIN]] = True
_LETTERS = re.compile(f"[a-z{''.join(LATIN)}]+")
# The rules under which a run of letters is a word of its own, whatever stands beside it.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Tokens:
    """Token ids of texts as little-endian bytes of type ``kind``, with a cache of words that holds
    about ``cached`` of them: those met since it was last half full, and those of the half before."""

    def __init__(self, path: str | None, cached: int = CACHED_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Regex, Tokenizer, normalizers, pre_tokenizers

        self.model = Tokenizer.from_file(path or tokenizer_path())
        self.cached, self.words, self.older = cached, {}, {}
        self.size = self.model.get_vocab_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        rules = [
            normalizers.Sequence([normalizers.NFC(), normalizers.Replace(Regex(r"\s+"), " "), normalizers.Lowercase()]),
            pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(_SPLIT), "removed", invert=True), level]),
        ]
        own = [self.model.normalizer, self.model.pre_tokenizer]
        self.by_class = [x and x.__getstate__() for x in own] == [x.__getstate__() for x in rules]
        self.latin = {ord(c): level.pre_tokenize_str(c.lower())[0][0] for c in LATIN}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Each different word of ``texts`` is looked up once. A-Z are lower-cased as the tokenizer does, unless a
        special token may occur."""
        lowered = pa.array([t if b"<|" in t else t.lower() for t in texts], pa.binary())
        split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.string(), len(lowered), lowered.buffers()))
        found = split.values.dictionary_encode()
        parts, bounds = self._cut(found.dictionary)
        coded = self._look_up(parts)
        ends = np.cumsum([0, *map(len, coded)])[bounds].astype(np.int32)
        ids = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(b"".join(coded))])
        ids = ids.take(found.indices)
        at = text_offsets(ids)[split.offsets.to_numpy()].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]

    def _cut(self, words: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Parts of words, cut where the tokenizer cuts as well: between letters, digits and punctuation, and between
        digits; words that may hold a special token stay whole. With the number of parts before each word."""
        at = text_offsets(words)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
        at -= at[0]
        left, right = _CLASS[data[:-1]], _CLASS[data[1:]]
        if self.by_class:
            latin = np.flatnonzero(_LATIN[data[:-1].astype(np.uint16) << 8 | data[1:]])
            classes = np.append(left, right[-1:])
            classes[latin] = classes[latin + 1] = _LETTER
            left, right = classes[:-1], classes[1:]
            marks = (left > 0) & (right > 0) & ((left != right) | (right == _DIGIT))
        else:
            marks = (left > 0) & (left < _MARK) & (right == _MARK)
        marks = np.flatnonzero(marks) + 1
        special = pc.match_substring(words, "<|").to_numpy(zero_copy_only=False)
        if special.any():
            marks = marks[~special[np.searchsorted(at, marks, "right") - 1]]
        starts = np.zeros(len(data) + 1, bool)
        starts[at] = starts[marks] = True
        starts = np.flatnonzero(starts)
        parts = np.insert(data, starts[1:-1], 32).tobytes().split()
        return parts, np.searchsorted(starts, at)

    def _look_up(self, parts: list[bytes]) -> list[bytes]:
        wanted = set(parts).difference(self.words)
        if 2 * (len(self.words) + len(wanted)) > self.cached:  # words in use come back from the older half
            self.older, self.words = self.words, {}
            wanted = set(parts)
        known = wanted.intersection(self.older)
        self.words.update(zip(known, map(self.older.__getitem__, known)))
        others = self._learn_letters(list(wanted.difference(known)))
        for start in range(0, len(others), 4096):
            self._learn(others[start:start + 4096])
        return list(map(self.words.__getitem__, parts))

    def _learn_letters(self, words: list[bytes]) -> list[bytes]:
        """Runs of letters need only the tokenizer's model; the other words are returned."""
        if not self.by_class:
            return words
        others, learned, ids, ends = [], [], [], [0]
        tokenize = self.model.model.tokenize
        for word in words:
            text = word.decode("utf-8", "replace")
            if _LETTERS.fullmatch(text):
                ids += [t.id for t in tokenize(text if text.isascii() else text.translate(self.latin))]
                ends.append(len(ids))
                learned.append(word)
            else:
                others.append(word)
        coded = np.array(ids, self.kind).tobytes()
        at = [self.kind.itemsize * end for end in ends]
        self.words.update((w, coded[a:b]) for w, a, b in zip(learned, at[:-1], at[1:], strict=True))
        return others

    def _learn(self, words: list[bytes]) -> None:
        """Tokenize words as one text, and deal its ids to them by their places."""
        texts = [w.decode("utf-8", "replace") for w in words]
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        coded = self.model.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(coded.ids, self.kind).tobytes()
        places = np.array([a for a, _ in coded.offsets], np.int64)
        ends = self.kind.itemsize * np.searchsorted(places, starts[1:], "left")
        first = 0
        for word, end in zip(words, ends.tolist(), strict=True):
            self.words[word] = ids[first:end]
            first = end


@functools.lru_cache(maxsize=1)
def shared_tokens(path: str | None) -> Tokens:
    """One cache for all tasks of a worker."""
    return Tokens(path)


def powers_of_two(n: int) -> list[int]:
    """``n`` as a sum of distinct powers of two, largest first."""
    return [1 << i for i in range(n.bit_length() - 1, -1, -1) if n >> i & 1]


class Index:
    """BM25 over the documents of one shard, with the postings of a term side by side."""

    def __init__(self, ids: list[np.ndarray]):
        self.size = n = len(ids)
        lengths = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate(ids)
        width = int(flat.max(initial=0)) + 1
        found = np.repeat(np.arange(n) * width, lengths) + flat  # document and term as one number
        found = np.sort(found.astype(np.uint32 if n * width <= 1 << 32 else np.int64))
        first = np.flatnonzero(np.append(True, found[1:] != found[:-1])[:len(found)])
        docs, terms = np.divmod(found[first].astype(np.int64), width)
        counts = np.diff(np.append(first, len(found))).astype(np.float64)
        self.terms = np.split(terms, np.searchsorted(docs, np.arange(1, n)))
        lengths = lengths.astype(np.float64)
        order = np.argsort(terms.astype(flat.dtype), kind="stable")
        top = int(terms.max()) + 2 if len(terms) else 1
        self.begin = np.searchsorted(terms[order], np.arange(top))
        spread = np.diff(np.append(self.begin, len(terms)))
        idf = np.log1p((n - spread + 0.5) / (spread + 0.5))
        norm = K1 * (1 - B + B * lengths / max(1.0, lengths.mean() if n else 1.0))
        self.docs = docs[order]
        self.weights = (idf[terms] * counts * (K1 + 1) / (counts + norm[docs]))[order]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 score of every document for the terms of ``seed``."""
        terms = self.terms[seed]
        starts, sizes = self.begin[terms], self.begin[terms + 1] - self.begin[terms]
        flat = np.arange(sizes.sum()) + np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        return np.bincount(self.docs[flat], self.weights[flat], minlength=self.size)


def pack_shard(ids: list[np.ndarray], window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of ``(document, start, length)``; all but the last are full or powers of two."""
    index = Index(ids)
    total = [len(x) for x in ids]
    done = [0] * len(ids)  # ids already placed
    unused = 0  # no unused document before this one
    for seed in range(len(ids)):
        while total[seed] - done[seed] >= window:
            yield [(seed, done[seed], window)]
            done[seed] += window
        rest = total[seed] - done[seed]
        if not rest:
            continue
        pieces, room = [(seed, done[seed], rest)], window - rest
        done[seed] = total[seed]
        scores = index.scores(seed)
        ranked = np.argsort(-scores, kind="stable")
        for other in ranked[scores[ranked] > 0].tolist() + [-1]:
            if not room:
                break
            while room and (other >= 0 or unused < len(ids)):
                at = other if other >= 0 else unused
                length = min(room, total[at] - done[at])
                if length:
                    pieces.append((at, done[at], length))
                    done[at] += length
                    room -= length
                if other >= 0:
                    break
                if done[at] == total[at]:
                    unused += 1
        if not room:
            yield pieces
            continue
        for size in powers_of_two(window - room):  # the shard's last
            part = []
            while size:
                at, start, length = pieces[0]
                take = min(size, length)
                part.append((at, start, take))
                size -= take
                pieces = pieces[1:] if take == length else [(at, start + take, length - take), *pieces[1:]]
            yield part


def tokenized(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_token: int = END_TOKEN, path: str | None = None
) -> DataFrame:
    """Rows ``(key, row, ids)`` of all documents, and one per task with the numbers of its documents that hold each
    token (``terms``, ``counts``; the term after the vocabulary counts all ids)."""
    known = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = known.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared_tokens(path)
        row = TaskContext.get().partitionId() << 33
        end = np.array([end_token], tokens.kind).tobytes()
        held_by, last_at = np.zeros(tokens.size + 1, np.int64), np.zeros(tokens.size, np.int64)
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            text, offsets = batch.column(1), text_offsets(batch.column(1))
            data = text.buffers()[2]
            data = memoryview(data) if data is not None else memoryview(b"")
            first = 0
            while first < len(text):
                last = int(np.searchsorted(offsets, offsets[first] + PIECE, "right")) - 1
                last = min(len(text), max(first + 1, last))
                texts = [bytes(data[offsets[i]:offsets[i + 1]]) for i in range(first, last)]
                ids = [coded + end for coded in tokens.encode(texts)]
                for coded in ids:
                    found = np.frombuffer(coded, tokens.kind)
                    places = np.arange(len(found))
                    last_at[found] = places
                    held_by[found[last_at[found] == places]] += 1
                    held_by[-1] += len(found)
                n = last - first
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), pa.array(np.arange(row, row + n)), pa.array(ids, pa.binary()),
                    pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int64())),
                ], ["key", "row", "ids", "terms", "counts"])
                row += n
                first = last
        if kind is not None:
            terms = np.flatnonzero(held_by)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                pa.array([terms], pa.list_(pa.int32())), pa.array([held_by[terms]], pa.list_(pa.int64())),
            ], ["key", "row", "ids", "terms", "counts"])

    return known.mapInArrow(run, f"key {kind}, row bigint, ids binary, terms array<int>, counts array<bigint>")


def draws(held_by: np.ndarray, documents: int) -> np.ndarray:
    """A row per min-hash with the draw of every token: exponential, at a rate of the fourth power of its IDF. A token
    of one document or of all draws infinity, so it never brings documents together."""
    idf = np.log(np.maximum(documents, 1) / np.maximum(held_by, 1))
    rate = np.where(held_by > 1, idf ** 4, 0.0)
    seeds = np.arange(DEAL * len(held_by), dtype=np.uint64).reshape(DEAL, -1)
    uniform = ((mix(seeds) >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
    return np.where(rate > 0, -np.log(uniform) / np.where(rate > 0, rate, 1.0), np.inf)


def dealt(stored: DataFrame, shard_tokens: int, end_token: int, tokens: Tokens) -> DataFrame:
    """The documents of ``tokenized``, sorted in tasks by what their rare tokens share."""
    parts = stored.filter("terms is not null").select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    total = parts.groupBy("t.terms").agg(F.sum("t.counts").alias("n")).toArrow()  # one row per token at most
    terms, n = total.column(0).to_numpy(), total.column(1).to_numpy()
    held_by = np.zeros(tokens.size + 1, np.int64)
    held_by[terms] = n
    size, held_by, kind = int(held_by[-1]), held_by[:-1], tokens.kind
    drawn = draws(held_by, int(held_by[end_token]))  # all documents hold the end token
    tasks = min(MAX_TASKS, max(1, size // (TASK_SHARDS * shard_tokens)))
    names = [f"deal{i}" for i in range(DEAL)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(2)
            at = text_offsets(ids)
            ends = at // kind.itemsize
            flat = np.frombuffer(ids.buffers()[2], kind, int(ends[-1] - ends[0]), int(at[0]))
            least = [np.minimum.reduceat(d[flat], ends[:-1] - ends[0]) for d in drawn]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, least)], [*batch.schema.names, *names])

    documents = stored.filter("ids is not null").select("key", "row", "ids")
    key = documents.schema["key"].dataType.simpleString()
    keyed = documents.mapInArrow(run, f"key {key}, row bigint, ids binary, " + ", ".join(f"{c} double" for c in names))
    return keyed.repartitionByRange(tasks, *names, "row").sortWithinPartitions(*names, "row").select("key", "ids")


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_token: int = END_TOKEN,
    path: str | None = None, shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    tokens = Tokens(path)
    if not 0 <= end_token < tokens.size:
        raise ValueError(f"the end token {end_token} is none of the {tokens.size} tokens")
    id_kind = tokens.kind
    stored = materialize(tokenized(docs, id_col, text_col, end_token, path), "tokens")
    kind = stored.schema["key"].dataType.simpleString()
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{n} bigint" for n in names[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        keys: list[pa.Array] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal keys, held, size, sequence
            columns: list[list[int]] = [[] for _ in names]
            for pieces in pack_shard(held, window):
                offset = 0
                for at, start, length in pieces:
                    crc = zlib.crc32(held[at][start:start + length].astype("<u4"))
                    row = (at, start, length, crc, len(held[at]), sequence, offset)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += length
                sequence += 1
            own = pa.concat_arrays(keys).take(pa.array(columns[0], pa.int64()))
            keys, held, size = [], [], 0
            return pa.RecordBatch.from_arrays([own, *(pa.array(c, pa.int64()) for c in columns[1:])], names)

        for batch in batches:
            for i, coded in enumerate(batch.column(1)):
                keys.append(batch.column(0).slice(i, 1))
                held.append(np.frombuffer(coded.as_py(), id_kind))
                size += len(held[-1])
                if size >= shard_tokens:
                    yield flush()
        if held:
            yield flush()

    return dealt(stored, shard_tokens, end_token, tokens).mapInArrow(run, schema)
