"""Token-id files: concatenated ids with Elias-Fano document boundaries.

A file holds the ids of its documents one after another (two bytes an id where the vocabulary allows it, else four), then the
boundaries and the doc_ids as Elias-Fano sequences, then a JSON footer that names the sections. An Elias-Fano sequence of n
values up to u keeps the low ``log2(u / n)`` bits of each and the high parts in unary: about ``2 + log2(u / n)`` bits a value. The
place of every ``SELECT_STEP``-th one bit is kept in four bytes, so a boundary is found without decoding those before it,
and no table of 64-bit offsets exists.

Documents are dealt out by ranges of doc_id and sorted, so files in (task, number) order hold them in ascending order. Every task
writes files of its own of at most ``FILE_IDS`` ids or ``FILE_DOCS`` documents (or one longer document) and returns a manifest row for each.
Spark commits the manifest as a table; a file that a lost or repeated task left behind is in no row and never read. The ids
before a file are prefix sums over the manifest, in two levels.

Encoding cuts a text at spaces that follow a character other than white space. No match of the tokenizer's pattern crosses such a
place, so pieces are encoded by themselves: pieces, and the pre-tokens of those not seen lately, have bounded caches in each worker, and what
is in neither goes to the library. Texts that hold a special string,
and tokenizers set up in another way, are encoded whole by the library.

Defined results: a null or empty text is the end id alone; rows that repeat a doc_id are documents of their own, in the order of
their text's hash; null doc_ids come last; very long texts are encoded whole; an empty table gives no files and no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alpina.llm.common import staged
from alpina.llm.warc import _filesystem as filesystem
from alpina.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
MAGIC = b"ALTOKID1"
FILE_IDS = 1 << 25
FILE_DOCS = 1 << 18
READ_BYTES = 32 << 20
SELECT_STEP = 256
CACHE_PIECES = 1_000_000
RENEW = 8
PIECE_CHARS = 64
FILE_BLOCK = 1024
#: fixed value: the byte-level pre-token pattern of the tokenizers library
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
MANIFEST = "part long, number long, file string, n_docs long, n_ids long, n_bytes long"
DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

_tokenizers: dict[str, Encoder] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class _Cache:
    """Values of the first ``size`` keys seen. Frequent keys come early, so a full cache is kept as it is, until the keys that it
    missed since are ``RENEW`` times its size."""

    def __init__(self, size: int):
        self.size, self.known, self.missed = size, {}, 0

    def all(self, keys: list[str], make: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """The values of ``keys``; ``make`` gives those of distinct unknown ones."""
        out = list(map(self.known.get, keys))
        gaps = [i for i, v in enumerate(out) if v is None]
        if not gaps:
            return out
        unknown = list({keys[i]: None for i in gaps})
        made = dict(zip(unknown, make(unknown), strict=True))
        for i in gaps:
            out[i] = made[keys[i]]
        if len(self.known) < self.size:
            self.known.update((k, v) for k, v in made.items() if len(k) <= PIECE_CHARS)
        else:
            self.missed += len(made)
            if self.missed > RENEW * self.size:
                self.known, self.missed = {}, 0
        return out


class Encoder:
    """Ids of texts as the tokenizers library gives them, as little-endian bytes."""

    _cut = re.compile(r"(?<=\S)(?= )")
    _run = re.compile(r" (?<=\s )")
    #: characters whose class no Unicode version changed: pieces of them are split further without the library
    _plain = re.compile("[\n!-~\u00a1-\u024f]+")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            setup = json.load(f)
        before, model = setup.get("pre_tokenizer") or {}, setup["model"]
        self.by_piece = (not setup.get("normalizer") and not setup.get("truncation") and not setup.get("padding")
                         and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
                         and model["type"] == "BPE" and not model.get("dropout"))
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        size = max(self.library.get_vocab_size(with_added_tokens=True), END_ID + 1)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.starts, self.spaced, self.bare = (_Cache(n) for n in (CACHE_PIECES // 8, CACHE_PIECES, CACHE_PIECES // 8))

    def _bytes(self, ids: list[int]) -> bytes:
        out = array("H" if self.dtype.itemsize == 2 else "I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _library(self, texts: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words that follow a space, in one text: the library says which word an id is of."""
        if len(words) > 1:
            found = self.library.encode(" " + " ".join(words), add_special_tokens=False)
            ids, word = self._bytes(found.ids), np.array(found.word_ids)
            cuts = [0, *(self.dtype.itemsize * (np.flatnonzero(word[1:] != word[:-1]) + 1)).tolist(), len(ids)]
            if len(cuts) == len(words) + 1:
                return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return self._library([" " + w for w in words])

    def _after_space(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces that follow a space, by way of their pre-tokens where these are certain."""
        out: dict[str, bytes] = {}
        words = [p for p in pieces if p.isalpha()]
        out.update(zip(words, self._words(words), strict=True))
        split = {p: PRE_TOKEN.findall(" " + p) for p in pieces if p not in out and self._plain.fullmatch(p)}
        if split:
            heads = self.spaced.all([x[0][1:] for x in split.values()], self._each)
            tails = iter(self.bare.all([t for x in split.values() for t in x[1:]], self._library))
            out.update((p, b"".join([head, *[next(tails) for _ in x[1:]]])) for (p, x), head in zip(split.items(), heads, strict=True))
        rest = [p for p in pieces if p not in out]
        if rest:
            out.update(zip(rest, self._each(rest), strict=True))
        return [out[p] for p in pieces]

    def _each(self, pieces: list[str]) -> list[bytes]:
        if all(map(str.isalpha, pieces)):
            return self._words(pieces)
        return self._library([" " + p for p in pieces])

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_piece or any(s in text for s in self.special):
            return self._library([text])[0]
        first, *rest = text.split(" ")
        if self._run.search(text):  # a run of white space that a cut at each space would divide
            first, *rest = self._cut.split(text)
            rest = [p[1:] for p in rest]
        return b"".join([*self.starts.all([first], self._library), *self.spaced.all(rest, self._after_space)])


def _encoder(path: str) -> Encoder:
    if path not in _tokenizers:
        _tokenizers[path] = Encoder(path)
    return _tokenizers[path]


class EliasFano:
    """A non-decreasing sequence of unsigned integers with random access by select."""

    def __init__(self, n: int, width: int, low: bytes, high: bytes, places: bytes):
        self.n, self.width, self.low = n, width, low
        self.high = np.frombuffer(high, dtype=np.uint8)
        self.places = np.frombuffer(places, dtype="<u4")

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        width = max(0, (int(values[-1]) // n).bit_length() - 1)
        bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little").tobytes()
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, dtype=np.uint8)
        high[ones] = 1
        return cls(n, width, low, np.packbits(high, bitorder="little").tobytes(), ones[::SELECT_STEP].astype("<u4").tobytes())

    def __len__(self) -> int:
        return self.n

    def sections(self) -> list[bytes]:
        return [self.low, self.high.tobytes(), self.places.tobytes()]

    def _select(self, i: int) -> int:
        """Place of the i-th one bit: from the kept place before it over the bytes in between."""
        at, left = int(self.places[i // SELECT_STEP]), i % SELECT_STEP
        byte = at >> 3
        chunk = self.high[byte:byte + 64].copy()
        chunk[0] &= (0xFF << (at & 7)) & 0xFF
        while (ones := int(np.bitwise_count(chunk).sum())) <= left:
            left, byte = left - ones, byte + len(chunk)
            chunk = self.high[byte:byte + 64]
        return (byte << 3) + int(np.flatnonzero(np.unpackbits(chunk, bitorder="little"))[left])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        first = i * self.width
        part = int.from_bytes(self.low[first >> 3:(first + self.width + 7) >> 3], "little") >> (first & 7)
        return ((self._select(i) - i) << self.width) | (part & ((1 << self.width) - 1))

    def values(self) -> np.ndarray:
        """The whole sequence, decoded at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.width)
        if self.width:
            bits = np.unpackbits(np.frombuffer(self.low, dtype=np.uint8), bitorder="little")[:self.n * self.width]
            for k in range(self.width):
                out |= bits[k::self.width].astype(np.uint64) << np.uint64(k)
        return out


class TokenFileWriter:
    """Documents in ascending order, written as they come; boundaries and footer follow when the file is closed."""

    def __init__(self, fs, path: str, dtype: np.dtype):
        self.out = fs.open_output_stream(path, compression=None)
        self.dtype, self.ends, self.ids, self.at = dtype, [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.at += len(ids) // self.dtype.itemsize
        self.ends.append(self.at)
        self.ids.append(doc_id)

    def close(self) -> int:
        """Bytes of the file."""
        known = np.array([i for i in self.ids if i is not None], dtype=np.int64)
        base = int(known[0]) if len(known) else 0
        lists = {"ends": EliasFano.of(np.array(self.ends)), "doc_ids": EliasFano.of(known.view(np.uint64) - np.int64(base).view(np.uint64))}
        footer = {"id_bytes": self.dtype.itemsize, "n_docs": len(self.ends), "n_ids": self.at, "base": base}
        at = self.at * self.dtype.itemsize
        for name, ef in lists.items():
            footer[name] = {"n": len(ef), "width": ef.width, "at": []}
            for section in ef.sections():
                footer[name]["at"].append([at, len(section)])
                self.out.write(section)
                at += len(section)
        tail = json.dumps(footer).encode()
        self.out.write(tail + len(tail).to_bytes(4, "little") + MAGIC)
        self.out.close()
        return at + len(tail) + 4 + len(MAGIC)


class TokenFile:
    """A written file: doc_ids, boundaries and ids of any document."""

    def __init__(self, fs, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        end = self.file.read_at(4 + len(MAGIC), size - 4 - len(MAGIC))
        if end[4:] != MAGIC:
            raise ValueError(f"{path}: not a token-id file")
        length = int.from_bytes(end[:4], "little")
        self.footer = json.loads(self.file.read_at(length, size - 4 - len(MAGIC) - length))
        self.dtype = np.dtype(f"<u{self.footer['id_bytes']}")
        self.ends, self._ids = (EliasFano(x["n"], x["width"], *(self.file.read_at(n, at) for at, n in x["at"]))
                                for x in (self.footer["ends"], self.footer["doc_ids"]))

    def __len__(self) -> int:
        return self.footer["n_docs"]

    def __enter__(self) -> TokenFile:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def doc_ids(self) -> tuple[np.ndarray, int]:
        """The known ids in order, and how many documents without id follow."""
        return (self._ids.values() + np.int64(self.footer["base"]).view(np.uint64)).view(np.int64), len(self) - len(self._ids)

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends[i - 1] if i else 0), self.ends[i]

    def ids(self, start: int, end: int) -> np.ndarray:
        w = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((end - start) * w, start * w), dtype=self.dtype)

    def document(self, i: int) -> np.ndarray:
        return self.ids(*self.bounds(i))


def write_token_files(docs: DataFrame, folder: str | None = None, *, id_col: str = "doc_id", text_col: str = "text",
                      path: str | None = None, end_id: int = END_ID) -> tuple[str, DataFrame]:
    """Encode and write all documents; returns the folder and the manifest (``MANIFEST``), one row per file."""
    folder, path = folder or scratch_path(docs.sparkSession, "token-ids"), path or tokenizer_path()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        fs, root = filesystem(folder)
        encoder, part = _encoder(path), TaskContext.get().partitionId()
        stop = np.array([end_id], dtype=encoder.dtype).tobytes()
        out, name, rows = None, "", []

        def close() -> None:
            rows.append({"part": part, "number": len(rows), "file": name, "n_docs": len(out.ends), "n_ids": out.at, "n_bytes": out.close()})

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoder.encode(text) + stop
                if out is not None and (out.at + len(ids) // encoder.dtype.itemsize > FILE_IDS or len(out.ends) >= FILE_DOCS):
                    close()
                    out = None
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.ids"
                    out = TokenFileWriter(fs, f"{root}/{name}", encoder.dtype)
                out.add(doc_id, ids)
        if out is not None:
            close()
        schema = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in MANIFEST.split(", ")])
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    text = F.coalesce(F.col(text_col), F.lit(""))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return folder, staged(dealt.mapInArrow(write, MANIFEST), "token-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the number of ids in all files before: sums of blocks of tasks, then inside a block."""
    block = F.floor(F.col("part") / FILE_BLOCK)
    files = manifest.withColumn("block", block)
    sums = files.groupBy("block").agg(F.sum("n_ids").alias("ids"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = Window.partitionBy("block").orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return (files.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
            .join(sums.select("block", before.alias("before")), "block")
            .select("part", "number", "file", "n_docs", "n_ids", "n_bytes", (F.col("before") + F.col("inside")).alias("start")))


def read_token_files(folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids_crc32``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with TokenFile(fs, f"{root}/{name}") as f:
                    known, unknown = f.doc_ids()
                    doc_ids = [*known.tolist(), *[None] * unknown]
                    ends = np.r_[0, f.ends.values().astype(np.int64)]
                    at = 0
                    while at < len(f):  # about READ_BYTES of ids at once
                        to = max(at + 1, int(np.searchsorted(ends, ends[at] + READ_BYTES // f.dtype.itemsize, side="right")) - 1)
                        ids, cut = f.ids(int(ends[at]), int(ends[to])), ends[at:to + 1] - ends[at]
                        crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(doc_ids[at:to], pa.int64()), pa.array(before + ends[at:to], pa.int64()),
                             pa.array(np.diff(cut), pa.int64()), pa.array(crc, pa.int64())], schema=DOCUMENTS)
                        at = to

    placed = staged(with_starts(manifest), "token-files")
    total = placed.agg(F.sum("n_bytes")).first()[0] or 0
    tasks = max(1, -(-total // READ_BYTES))
    return (placed.select("file", "start").repartition(tasks, "file")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_round_trip(docs: DataFrame) -> DataFrame:
    """Write all documents, read every file back: one row per document."""
    folder, manifest = write_token_files(docs)
    return read_token_files(folder, manifest)
