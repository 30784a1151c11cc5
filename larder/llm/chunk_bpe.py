"""BPE by content-defined chunks: a chunk that documents share is encoded once, and the joins of chunks are encoded again."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from larder.llm.bpe import WordEncoder, encoder, vocabulary_path
from larder.llm.common import PACKED_BYTES, only, slices, utf8
from larder.session import cut

#: A chunk ends where the hash of the last 8 bytes has so many zero bits, every 1024 bytes on average.
CHUNK_BITS = 10
_SPACE = b"\t\n\x0b\x0c\r "


def cuts(text: bytes, bits: int = CHUNK_BITS) -> list[int]:
    """Ends of the chunks of a text, its length last. They depend on the eight bytes before them alone."""
    ends: list[np.ndarray] = []
    for shift in range(min(8, max(0, len(text) - 7))):
        values = np.frombuffer(text, "<u8", (len(text) - shift) // 8, shift)
        hashed = (values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
        ends.append(np.flatnonzero(hashed == 0) * 8 + shift + 8)
    found = np.sort(np.concatenate(ends)).tolist() if ends else []
    return found if found and found[-1] == len(text) else [*found, len(text)]


class Encoded(NamedTuple):
    """A chunk: the open word at its start, its whole words, the first and last of them, and the open word at its end.

    Without white space all of the chunk is ``head`` and ``closed`` is false.
    """

    head: bytes
    first: bytes
    ids: bytes
    last: bytes
    tail: bytes
    closed: bool


def encode_chunk(chunk: bytes, words: WordEncoder) -> Encoded:
    if len(chunk) == len(chunk.translate(None, _SPACE)):
        return Encoded(chunk, b"", b"", b"", b"", False)
    whole = chunk.split()
    head = b"" if chunk[0] in _SPACE else whole.pop(0)
    tail = b"" if chunk[-1] in _SPACE else whole.pop()
    ids = words.encode(b" ".join(whole)).tobytes()
    return Encoded(head, whole[0] if whole else b"", ids, whole[-1] if whole else b"", tail, True)


def stitch(chunks: list[Encoded], words: WordEncoder) -> np.ndarray:
    """The ids of a text from its chunks. At each join the open words of both sides are encoded again by the library, together with the
    whole words beside them, which must come out as they did inside their chunks: then all ids further out agree as well."""
    out: list[bytes] = []
    held, last = b"", b""
    for k, chunk in enumerate(chunks):
        held += chunk.head
        if chunk.closed:
            out += [_joined(last, held, chunk.first, words), chunk.ids]
            held, last = chunk.tail, chunk.last
    out.append(_joined(last, held, b"", words))
    return np.frombuffer(b"".join(out), words.width)


def _joined(left: bytes, held: bytes, right: bytes, words: WordEncoder) -> bytes:
    if not held:
        return b""
    window = b" ".join(w for w in (left, held, right) if w)
    ids = np.array(words.tokenizer.encode(window.decode(), add_special_tokens=False).ids, words.width).tobytes()
    before, after = (words.encode(w).tobytes() for w in (left, right))
    if not (ids.startswith(before) and ids.endswith(after) and len(ids) >= len(before) + len(after)):
        raise ValueError("ids next to a join of chunks differ from those inside the chunk: this vocabulary does not split at white space")
    return ids[len(before) : len(ids) - len(after)]


def _key(data: bytes) -> bytes:
    return xxhash.xxh3_128_digest(data)


class Digests:
    """Digests of ids and of the text they decode to."""

    def __init__(self, words: WordEncoder) -> None:
        tokenizer = words.tokenizer
        size = tokenizer.get_vocab_size()
        self.numbers = [str(k).encode() for k in range(size)]
        self.tokens = [(tokenizer.id_to_token(k) or "").encode() for k in range(size)]
        self.joins = tokenizer.decoder is None
        self.tokenizer = tokenizer

    def decoded(self, ids: list[int]) -> bytes:
        # Without a decoder the library puts one space between tokens.
        return b" ".join([self.tokens[k] for k in ids]) if self.joins else self.tokenizer.decode(ids, skip_special_tokens=False).encode()

    def row(self, ids: np.ndarray) -> dict:
        listed = ids.tolist()
        numbers = self.numbers
        return {
            "n_tokens": len(listed),
            "ids_sha256": hashlib.sha256(b" ".join([numbers[k] for k in listed])).hexdigest(),
            "decoded_sha256": hashlib.sha256(self.decoded(listed)).hexdigest(),
        }


_DIGESTS: dict[str, Digests] = {}


def _digests(path: str) -> Digests:
    if path not in _DIGESTS:
        _DIGESTS[path] = Digests(encoder(path))
    return _DIGESTS[path]


_PARTS = "struct<head:binary,first:binary,ids:binary,last:binary,tail:binary,closed:boolean>"
_SENT = f"parts array<struct<at:int,chunk_key:binary,part:{_PARTS}>>, shared array<struct<chunk_key:binary,part:{_PARTS}>>"


def _pack(ids: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(ids)


def _unpack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _encoded(documents: DataFrame, doc_id: str, text: str, path: str, bits: int, finish: Callable[[np.ndarray], dict], result: str) -> DataFrame:
    """doc_id and what ``finish`` makes of the ids of every text, columns ``result``.

    Equal texts are one text. Chunks found in two or more texts have an owner, the text of the smallest key; the owner's task encodes them,
    and the others get the ids by a join on the chunk's key. All other chunks are encoded where their text is. Keys are 128-bit hashes.
    """
    docs = only(documents, doc_id=doc_id, text=text).select("doc_id", utf8(F.col("text")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = StructType.fromDDL(result).names

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches, "text"):
            keys, chunks = [], []
            for data in some.column(1).to_pylist():
                ends = cuts(data, bits)
                keys.append(_key(data))
                chunks.append([_key(data[a:b]) for a, b in zip([0, *ends], ends, strict=False)])
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(keys, pa.binary()), pa.array(chunks, pa.list_(pa.binary()))], ["doc_id", "text_key", "chunks"])

    marked = cut(docs.mapInArrow(chunked, f"doc_id {kind}, text_key binary, chunks array<binary>"))
    # One row for a text, and for a chunk in it.
    texts = cut(marked.groupBy("text_key").agg(F.min("chunks").alias("chunks")))
    held = texts.select("text_key", F.explode(F.array_distinct("chunks")).alias("chunk_key"))
    # Written out, as are the other small sides below: both sides of each join are then plain exchanges, whose hot keys can be split.
    owners = cut(held.groupBy("chunk_key").agg(F.min("text_key").alias("owner"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    is_owner = F.col("owner") == F.col("text_key")
    roles = cut(
        held.join(owners, "chunk_key").groupBy("text_key").agg(
            F.collect_list(F.when(is_owner, F.col("chunk_key"))).alias("owned"), F.collect_list(F.when(~is_owner, F.col("chunk_key"))).alias("borrowed")
        )
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches, "text"):
            data = some.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([_key(t) for t in data], pa.binary()), pa.array([_pack(t) for t in data], pa.binary())], ["text_key", "text"])

    schema = f"text_key binary, done boolean, {result}, {_SENT}"
    arrow, arrow_result = (to_arrow_schema(StructType.fromDDL(ddl)) for ddl in (schema, f"text_key binary, {result}"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = encoder(path), set()
        for some in slices(batches, "text", max_bytes=PACKED_BYTES):
            rows = []
            for r in some.to_pylist():
                if r["text_key"] in seen:  # another copy of the text
                    continue
                seen.add(r["text_key"])
                data, owned, borrowed = _unpack(r["text"]), set(r["owned"] or ()), set(r["borrowed"] or ())
                ends, parts, shared = cuts(data, bits), [], {}
                for a, b in zip([0, *ends], ends, strict=False):
                    chunk = data[a:b]
                    key = _key(chunk) if owned or borrowed else b""
                    part = None if key in borrowed else shared.get(key) or encode_chunk(chunk, words)
                    parts.append((key, part))
                    if key in owned:
                        shared[key] = part
                row = {"text_key": r["text_key"], "done": not borrowed}
                if borrowed:
                    row["parts"] = [{"at": k, "chunk_key": key if part is None else None, "part": part and part._asdict()} for k, (key, part) in enumerate(parts)]
                else:
                    row |= finish(stitch([part for _, part in parts], words))
                rows.append(row | {"shared": [{"chunk_key": key, "part": part._asdict()} for key, part in shared.items()]})
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    sent = docs.select("text").mapInArrow(packed, "text_key binary, text binary").join(roles, "text_key", "left")
    first = cut(sent.select("text_key", "text", "owned", "borrowed").mapInArrow(encoded, schema))
    pieces = first.filter("NOT done").select("text_key", F.explode("parts").alias("p")).select("text_key", "p.*")
    own = pieces.filter("chunk_key IS NULL").select("text_key", "at", "part")
    lent = cut(first.select(F.explode("shared").alias("s")).select("s.*").dropDuplicates(["chunk_key"]))
    got = pieces.filter("chunk_key IS NOT NULL").select("text_key", "at", "chunk_key").join(lent, "chunk_key").select("text_key", "at", "part")
    lists = own.unionByName(got).groupBy("text_key").agg(F.sort_array(F.collect_set(F.struct("at", "part"))).alias("parts"))

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                rows = [{"text_key": r["text_key"]} | finish(stitch([Encoded(**p["part"]) for p in r["parts"]], words)) for r in batch.slice(start, 512).to_pylist()]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow_result)

    done = first.filter("done").select("text_key", *names).unionByName(lists.mapInArrow(repaired, f"text_key binary, {result}"))
    return marked.select("doc_id", "text_key").join(cut(done.dropDuplicates(["text_key"])), "text_key").select("doc_id", *names)


def encode(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, bits: int = CHUNK_BITS) -> DataFrame:
    """doc_id and ids (array of int) of every whole text, equal to the library's without special tokens.

    A null text is empty and has no ids; repeated rows give repeated rows; other columns are ignored; an empty table gives none.
    """
    return _encoded(documents, doc_id, text, path or vocabulary_path(), bits, lambda ids: {"ids": ids.tolist()}, "ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of the rows of ``encode``, as the library decodes them, special tokens kept; no ids give an empty text."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _digests(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([texts.decoded(ids).decode() for ids in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def digests(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, bits: int = CHUNK_BITS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text: ``encode`` and ``decode`` with only digests kept, made in the same tasks. Rows are
    those of ``encode``: null texts are empty, repeated rows give repeated rows, an empty table gives none."""
    path = path or vocabulary_path()
    result = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _encoded(documents, doc_id, text, path, bits, lambda ids: _digests(path).row(ids), result)
