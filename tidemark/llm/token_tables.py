"""Token ids in sorted-string-table shards.

Documents are put in ascending doc_id order (a null id first, equal ids by text hash) by a range shuffle, each
partition is tokenised and written as one shard, and a shard can be read whole or searched.

A shard is blocks, an index, a Bloom filter and a footer. A block has entries (shared key bytes, own key bytes,
value length as varints, the key's own bytes, the value), compressed with zstd. Keys share the prefix of the key
before, and every RESTART entries a key is whole, which is where a search within the block starts. The index has each
block's last key, place and size; a lookup asks the Bloom filter, finds the block by binary search in the index and reads only it.
A key is 9 bytes: 0 for a null id, else 1 and the id as big-endian with its sign bit turned, so bytes sort as ids do. A value is
the token ids as little-endian integers of the width that the footer names.

At scale: one shuffle of the texts by (doc_id, text hash), so many rows of one id are also spread; a shard is written under a
name of its partition, first to a temporary file and then renamed, so a task that runs again writes the same shard
again. Only a row for each shard goes to the manifest.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._hashing import IS_SPACE, pieces, texts_of
from ._shared import lean, shared_dir, table

VOCABULARY = "word_bpe_49k.json"
END = 2
BLOCK_BYTES = 1 << 16
RESTART = 16
BLOOM_BITS = 10
MAGIC = b"TIDESST1"
FOOTER = struct.Struct("<QQQQQQB8s")
#: Words whose ids a worker keeps; beyond it the store starts anew. A word takes some 150 bytes.
KEPT_WORDS = 1 << 19
#: Runs of 1024 words that the library encodes in one call: what it returns is many times the size of the ids.
RUNS = 16
SEPARATOR = b"\x01"
#: The vocabulary is lower case and cuts between a letter and what is no letter, so A-Z are folded and a sign that follows
#: a letter is taken off before words are looked up; that leaves fewer different ones. An apostrophe may belong to the word.
IS_MARK, IS_LETTER = np.zeros(256, bool), np.zeros(256, bool)
IS_MARK[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = True
IS_LETTER[ord("a") : ord("z") + 1] = True
#: Texts with this may hold a special token, which is found in the text as it stands.
SPECIAL = b"<|"
#: Words of lower-case letters that no normal form and no case changes (a-z and those of Latin-1), in UTF-8.
LETTERS = re.compile(rb"[a-z]*(?:\xc3[\x9f-\xb6\xb8-\xbf][a-z]*)*").fullmatch
#: What word_bpe_49k.json does to a text before its merges: such a word is always one piece, as it stands.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PIECES = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}


def key_of(doc_id: int | None) -> bytes:
    return b"\0" * 9 if doc_id is None else b"\1" + struct.pack(">Q", (doc_id + (1 << 63)) & (2**64 - 1))


def id_of(key: bytes) -> int | None:
    return None if key[0] == 0 else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _probes(key: bytes, bits: int) -> list[int]:
    a, b = zlib.crc32(key), zlib.crc32(key[::-1], 0x5BD1E995) | 1
    return [((a << 16) + i * b) % bits for i in range(7)]


def write_shard(out, rows: Iterable[tuple[int | None, np.ndarray]], width: int = 2) -> dict:
    """Write rows (doc_id, ids) in their order to the binary file `out`; what the manifest says of the shard.
    Rows are taken one by one: memory holds a block, the index and the keys' hashes."""
    index, hashes, place = [], [], 0
    block, entries, before, docs, tokens = bytearray(), 0, b"", 0, 0
    first = last = None
    pack = zstandard.ZstdCompressor(level=1)

    def close() -> None:
        nonlocal place, block, entries, before
        data = pack.compress(bytes(block))
        index.append((before, place, len(data)))
        out.write(data)
        place += len(data)
        block, entries, before = bytearray(), 0, b""

    for doc_id, ids in rows:
        key = key_of(doc_id)
        shared = 0 if entries % RESTART == 0 else next((i for i, (a, b) in enumerate(zip(before, key)) if a != b), len(key))
        value = ids.astype(f"<u{width}").tobytes()
        block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        hashes.append(key)
        docs, tokens, entries, before = docs + 1, tokens + len(ids), entries + 1, key
        first, last = key if first is None else first, key
        if len(block) >= BLOCK_BYTES:
            close()
    if entries:
        close()
    bits = max(64, docs * BLOOM_BITS)
    bloom = np.zeros((bits + 7) // 8, np.uint8)
    for key in hashes:
        for p in _probes(key, bits):
            bloom[p >> 3] |= 1 << (p & 7)
    table = b"".join(_varint(len(k)) + k + _varint(p) + _varint(n) for k, p, n in index)
    out.write(table)
    out.write(bloom.tobytes())
    out.write(FOOTER.pack(place, len(table), place + len(table), bits, docs, tokens, width, MAGIC))
    return {"docs": docs, "tokens": tokens, "first_key": first, "last_key": last, "bytes": place + len(table) + len(bloom) + FOOTER.size}


class Shard:
    """A shard opened for reading: iterate over (doc_id, ids), or get(doc_id) -> list of ids arrays."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        file.seek(size - FOOTER.size)
        at, n, bloom_at, self.bits, self.docs, self.tokens, self.width, magic = FOOTER.unpack(file.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        file.seek(at)
        data, p = file.read(n), 0
        self.last, self.places = [], []
        while p < n:
            k, p = _number(data, p)
            key, p = data[p : p + k], p + k
            place, p = _number(data, p)
            length, p = _number(data, p)
            self.last.append(key)
            self.places.append((place, length))
        file.seek(bloom_at)
        self.bloom = file.read((self.bits + 7) // 8)

    def _block(self, i: int) -> Iterator[tuple[bytes, np.ndarray]]:
        place, length = self.places[i]
        self.file.seek(place)
        data, p, key = zstandard.ZstdDecompressor().decompress(self.file.read(length)), 0, b""
        while p < len(data):
            shared, p = _number(data, p)
            own, p = _number(data, p)
            n, p = _number(data, p)
            key = key[:shared] + data[p : p + own]
            p += own
            yield key, np.frombuffer(data, f"<u{self.width}", n // self.width, p)
            p += n

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for i in range(len(self.places)):
            for key, ids in self._block(i):
                yield id_of(key), ids

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        key = key_of(doc_id)
        if not all(self.bloom[p >> 3] >> (p & 7) & 1 for p in _probes(key, self.bits)):
            return []
        found, i = [], bisect_left(self.last, key)
        while i < len(self.places):
            found += [ids for k, ids in self._block(i) if k == key]
            if self.last[i] > key:
                break
            i += 1
        return found


def words_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The words of all texts in order, as they are looked up, and each text's number of them."""
    plain = [SPECIAL not in t for t in texts]
    data = np.frombuffer(b" ".join([*(t.lower() if ok else t for t, ok in zip(texts, plain)), b""]), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    cut = IS_MARK[data]
    cut[0] = False
    cut[1:] &= IS_LETTER[data[:-1]]
    for i in np.flatnonzero(~np.array(plain)):
        cut[ends[i] - len(texts[i]) - 1 : ends[i]] = False
    space = IS_SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    counts = np.diff(np.searchsorted(np.flatnonzero(first | cut), ends), prepend=0)
    return np.insert(data, np.flatnonzero(cut), ord(" ")).tobytes().split(), counts


class Encoder:
    """encode(texts) -> ids of each, the end id last. It serves lower-casing vocabularies whose merges stay within
    runs of letters, digits or other signs, as word_bpe_49k.json. The tokenizer's merges never cross white space, so a word's
    ids are asked for once and kept; the library encodes every different word."""

    def __init__(self, path: str, end: int = END):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        (self.bar,) = self.tokenizer.encode(SEPARATOR.decode(), add_special_tokens=False).ids
        self.letters, self.is_last = self._of_letters()
        self.clear()

    def _of_letters(self):
        """The tokenizer without its steps before the merges (it shares the model), for words of LETTERS, and which of its ids
        end a word; (None, None) if this tokenizer does other steps, or has no mark for the end of a word."""
        from tokenizers import Tokenizer, models, pre_tokenizers

        model, steps = self.tokenizer.model, (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)
        bytewise = {"add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        known = [{"type": "Sequence", "normalizers": NORMALIZER}, {"type": "Sequence", "pretokenizers": [PIECES, {"type": "ByteLevel"} | bytewise]}]
        if [x and json.loads(x.__getstate__()) for x in steps] != known or not isinstance(model, models.BPE) or model.dropout or not model.end_of_word_suffix:
            return None, None
        vocab, suffix = self.tokenizer.get_vocab(with_added_tokens=False), model.end_of_word_suffix
        if not all(c in vocab and c + suffix in vocab for c in pre_tokenizers.ByteLevel.alphabet()):
            return None, None
        letters = Tokenizer(model)
        letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(**bytewise)])
        is_last = np.zeros(max(vocab.values()) + 1, bool)
        is_last[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        return letters, is_last

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.size = np.empty(1 << 16, np.uint32), 0
        self.counts = np.empty(1 << 14, np.int64)

    @staticmethod
    def _room(array: np.ndarray, n: int) -> np.ndarray:
        return array if n <= len(array) else np.resize(array, max(n, 2 * len(array)))

    def _learn(self, words: list[bytes]) -> None:
        """Most words are of letters: the library spends more on the steps before the merges than on the merges."""
        simple, others = [], []
        for w in words:
            (simple if self.letters and LETTERS(w) else others).append(w)
        if simple:
            self._keep(simple, *self._encoded_letters(simple))
        if others:
            self._keep(others, *self._encoded(others))

    def _keep(self, words: list[bytes], flat: np.ndarray, counts: np.ndarray) -> None:
        first = len(self.known)
        self.flat = self._room(self.flat, self.size + len(flat))
        self.counts = self._room(self.counts, first + len(words))
        self.flat[self.size : self.size + len(flat)] = flat
        self.counts[first : first + len(words)] = counts
        self.size += len(flat)
        self.known.update(zip(words, range(first, first + len(words))))

    @staticmethod
    def _called(tokenizer, runs: list[str]) -> np.ndarray:
        """The ids of all runs, RUNS of them a call."""
        calls = (tokenizer.encode_batch_fast(runs[i : i + RUNS], add_special_tokens=False) for i in range(0, len(runs), RUNS))
        return np.concatenate([np.empty(0, np.uint32), *(np.array(e.ids, np.uint32) for found in calls for e in found)])

    def _encoded_letters(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As _encoded, for words of LETTERS; each is one piece, whose last id tells that it ends."""
        ids = self._called(self.letters, [b" ".join(words[i : i + 1024]).decode() for i in range(0, len(words), 1024)])
        return ids, np.diff(np.flatnonzero(self.is_last[ids]), prepend=-1)

    def _encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after another, and how many each has. Many are encoded in one call, with a word
        between them whose single id none of them can give."""
        bar, plain = self.bar, [SEPARATOR not in w for w in words]
        text = f" {SEPARATOR.decode()} "
        joined = [w.decode() for w, ok in zip(words, plain) if ok]
        runs = [text.join([*joined[i : i + 1024], ""]) for i in range(0, len(joined), 1024)]
        ids = self._called(self.tokenizer, runs)
        cuts = np.flatnonzero(ids == bar)
        counts = np.empty(len(words), np.int64)
        counts[plain] = np.diff(cuts, prepend=-1) - 1
        if all(plain):
            return ids[ids != bar], counts
        rest = [self.tokenizer.encode(w.decode(), add_special_tokens=False).ids for w, ok in zip(words, plain) if not ok]
        counts[~np.array(plain)] = [len(r) for r in rest]
        ends = np.cumsum(counts)
        flat = np.empty(int(ends[-1]), np.uint32)
        flat[np.repeat(plain, counts)] = ids[ids != bar]
        flat[~np.repeat(plain, counts)] = [i for r in rest for i in r]
        return flat, counts

    def _places(self, words: list[bytes]) -> np.ndarray:
        """Each word's number in the store, -1 if it isn't there."""
        return np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))

    def _ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and each word's number of ids."""
        at = self._places(words)
        if len(unknown := np.flatnonzero(at < 0)):
            new = {words[i] for i in unknown}
            if len(self.known) + len(new) > KEPT_WORDS:
                self.clear()
                new, unknown = set(words), np.arange(len(words))
            self._learn(list(new))
            at[unknown] = self._places([words[i] for i in unknown])
        counts = self.counts[: len(self.known)]
        n, first = counts[at], (np.cumsum(counts) - counts)[at]
        return self.flat[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))], n

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text, taken together in pieces of bounded size."""
        for start, stop in pieces(texts):
            words, n_words = words_of(texts[start:stop])
            found = [self._ids(words[i : i + KEPT_WORDS]) for i in range(0, len(words), KEPT_WORDS)]
            ids = np.concatenate([np.empty(0, np.uint32), *(f[0] for f in found)])
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.concatenate([np.empty(0, np.int64), *(f[1] for f in found)]))])
            at = ends[np.cumsum([0, *n_words])]
            for i, j in zip(at[:-1], at[1:]):
                yield np.append(ids[i:j], np.uint32(self.end))


#: A worker process keeps its encoders between tasks.
_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The worker's encoder. Tasks must come by this function: a task's own code is sent with copies of the globals it names."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def write_tables(docs: DataFrame, path: str, vocab: str | None = None, shards: int | None = None) -> DataFrame:
    """Encode `docs` (doc_id, text) into shards under `path`, which driver and executors reach by the same address;
    the manifest (shard, file, first_key, last_key, docs, tokens, bytes), a row for each shard that is not empty.

    A null text is empty: only the end id. Rows with the same id are all kept, in the order of their text hashes.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    vocab = vocab or vocabulary()
    ordered = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("h", F.xxhash64("text"))
        .repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.col("h"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocab)
        width = 2 if encoder.tokenizer.get_vocab_size() <= 1 << 16 else 4
        place, root = fs.FileSystem.from_uri(path)
        part = TaskContext.get().partitionId()
        name, draft = f"{root}/shard-{part:06d}.sst", f"{root}/.{part:06d}-{uuid.uuid4().hex}"

        def rows():
            for batch in batches:
                yield from zip(batch.column("doc_id").to_pylist(), encoder.encode(texts_of(batch.column("text"))))

        rows = rows()
        if (head := next(rows, None)) is None:
            return
        place.create_dir(root, recursive=True)
        with place.open_output_stream(draft) as out:
            told = write_shard(out, (r for part in ([head], rows) for r in part), width)
        place.move(draft, name)
        yield pa.RecordBatch.from_pylist([{"shard": part, "file": f"shard-{part:06d}.sst"} | told], MANIFEST_ARROW)

    spark_schema = "shard int, file string, first_key binary, last_key binary, docs long, tokens long, bytes long"
    manifest = f"{path}/manifest.parquet"
    ordered.select("doc_id", "text").mapInArrow(lean(write), spark_schema).write.mode("overwrite").parquet(manifest)
    return spark.read.schema(spark_schema).parquet(manifest)


#: A shard has about this many bytes of text at most, whatever the session's number of partitions.
SHARD_BYTES = 256 << 20
MANIFEST_ARROW = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("first_key", pa.binary()), ("last_key", pa.binary()), ("docs", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())])


def read_tables(manifest: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the shard files; `start` counts the ids
    of all documents before it. The running sum over shards is over the manifest's few rows."""
    starts = manifest.select("shard", "file", (F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")).alias("start"))
    n = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                at, out = row["start"], []
                with place.open_input_file(f"{root}/{row['file']}") as file:
                    for doc_id, ids in Shard(file):
                        out.append({"doc_id": doc_id, "start": at, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())})
                        at += len(ids)
                        if len(out) == 4096:
                            yield pa.RecordBatch.from_pylist(out, DOCUMENT_ARROW)
                            out = []
                if out:
                    yield pa.RecordBatch.from_pylist(out, DOCUMENT_ARROW)

    return starts.repartition(n, "shard").mapInArrow(lean(read), "doc_id long, start long, n_tokens long, ids_crc32 long")


DOCUMENT_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def tokenised(docs: DataFrame) -> DataFrame:
    path = f"{shared_dir(docs.sparkSession)}/tidemark/tokens-{uuid.uuid4().hex}"
    return read_tables(write_tables(docs, path), path)


def op7_token_tables(spark, sf_dir: str) -> DataFrame:
    return tokenised(table(spark, sf_dir, "documents").select("doc_id", "text"))
