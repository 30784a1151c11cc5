"""Cross-tokenizer alignment: token overlaps of two vocabularies, counted in inverted document bitmaps whose postings return the scores."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.bpe import byte_alphabet, vocabulary_path
from larder.llm.common import only, slices, utf8
from larder.session import cut

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A part of the index: so many links or documents at most, or one document. Local document numbers fit 16 bits.
PART_LINKS, PART_DOCS = 3_000_000, 1 << 16
#: Stretches of text kept per generation in a worker (two are held), and the longest that are kept.
MEMO, MEMO_CHARS = 80_000, 48
#: A pair is one number: the id of A above, that of B in the low bits.
B_BITS = 24

#: A space between two characters that are no white space: no token of either vocabulary reaches across it from the left.
_APART = re.compile(r"(?<=\S) (?=\S)")
_WIDE = re.compile(r"\s | \s|^ | $")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class Aligner:
    """Tokens of a text by both vocabularies, laid side by side.

    The byte-level vocabulary splits before a single space, and no piece of the other one holds a space behind another character (checked when the
    vocabulary is read; otherwise texts stay whole), so stretches between single spaces are encoded and aligned on their own, the frequent ones once.
    """

    def __init__(self, byte_path: str, piece_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = SentencePieceProcessor(model_file=piece_path)
        back = {c: b for b, c in byte_alphabet().items()}
        names = [self.a.id_to_token(k) or "" for k in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in names]
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        #: An id and what follows it: a comma, or behind the last of a group's A ids a bar, behind its last B id a semicolon.
        self.shown = [f"{k}{end}" for side, last in ((self.a_bytes, "|"), (self.b_bytes, ";")) for k in range(len(side)) for end in (",", last)]
        self.b_codes = 2 * len(self.a_bytes)
        self.apart = not any("▁" in p.lstrip("▁") for p in pieces)
        self.young: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def stretches(self, text: str) -> list[str]:
        if not self.apart:
            return [text]
        return _APART.split(text) if _WIDE.search(text) else text.split(" ")

    def laid(self, texts: list[str]) -> list[tuple | None]:
        """n_a, n_b, groups, number of groups and links of each text, none of them empty; None where its tokens do not give back its bytes."""
        a_ids = [x.ids for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        b_ids = self.b.encode(texts, num_threads=1)
        wholes = [b" " + t.encode() for t in texts]
        n_a, n_b = np.array([len(x) for x in a_ids]), np.array([len(x) for x in b_ids])
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in ((a_ids, n_a), (b_ids, n_b)))
        same = b"".join(map(self.a_bytes.__getitem__, a.tolist())) == b"".join(wholes) == b"".join(map(self.b_bytes.__getitem__, b.tolist()))
        ends = np.cumsum([len(w) for w in wholes])
        to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
        end_a, end_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        if not (same and n_a.all() and n_b.all() and (end_a[to_a - 1] == ends).all() and (end_b[to_b - 1] == ends).all()):
            if len(texts) == 1:
                return [None]
            half = len(texts) // 2  # the texts at fault are found by halves
            return self.laid(texts[:half]) + self.laid(texts[half:])
        # Stretches between ends of either side: each is shared by one A and one B token, and any two tokens share one at most.
        cuts = np.union1d(end_a, end_b)
        links = (a[np.searchsorted(end_a, cuts)] << B_BITS | b[np.searchsorted(end_b, cuts)]).tobytes()
        last_a, last_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
        common = end_a[last_a]
        # The ids of a group's A tokens come before those of its B tokens; a separator goes with each.
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        below_a, below_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=len(common)))]) for g in (group_a, group_b))
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + below_b[group_a]] = 2 * a + last_a
        codes[np.arange(len(b)) + below_a[group_b + 1]] = self.b_codes + 2 * b + last_b
        shown = list(map(self.shown.__getitem__, codes.tolist()))
        to_links, to_groups = np.searchsorted(cuts, ends, "right"), np.searchsorted(common, ends, "right")
        bounds = [(to_a + to_b).tolist(), (8 * to_links).tolist()]
        sizes = [n_a.tolist(), n_b.tolist(), np.diff(to_groups, prepend=0).tolist()]
        out, at, first = [], 0, 0
        for to, link, x, y, g in zip(*bounds, *sizes, strict=True):
            out.append((x, y, "".join(shown[at:to])[:-1], g, links[first:link]))
            at, first = to, link
        return out

    def learn(self, texts: list[list[str]]) -> dict[str, tuple | None]:
        """What is known of all stretches of ``texts``; new ones are encoded together."""
        known: dict[str, tuple | None] = {}
        new: list[str] = []
        young, old = self.young, self.old
        for s in set().union(*texts):
            found = young.get(s, False)
            if found is False and (found := old.get(s, False)) is not False:
                young[s] = found
            if found is False:
                new.append(s)
            else:
                known[s] = found
        if new:
            made = dict(zip(new, self.laid(new), strict=True))
            known |= made
            if len(young) >= MEMO:
                self.old, self.young = young, {}
            self.young.update((s, x) for s, x in made.items() if len(s) <= MEMO_CHARS)
        return known

    def align(self, texts: list[str]) -> list[tuple]:
        """n_a, n_b, n_groups, groups and links (packed pairs) of each text; zeros and nothing for an empty one and where bytes differ."""
        parts = [self.stretches(t) if t else [] for t in texts]
        known = self.learn(parts)
        out = []
        for part in parts:
            rows = [known[s] for s in part]
            if not rows or None in rows:
                out.append((0, 0, 0, "", b""))
                continue
            n_a, n_b, groups, n_groups, links = zip(*rows, strict=True)
            out.append((sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), b"".join(links)))
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_path: str | None = None, piece_path: str | None = None) -> Aligner:
    """The worker's aligner of two vocabulary files, made once."""
    key = byte_path or vocabulary_path(BYTE_VOCABULARY), piece_path or vocabulary_path(PIECE_VOCABULARY)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def _binaries(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """Rows of bytes that lie one after another in ``values`` from the places ``first`` on; an Arrow array without a copy for each row."""
    offsets = np.append(first, len(values)).astype(np.int32) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def postings(links: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array, pa.Array]]:
    """Inverted index of a part: for each plane its number, the ids of A and B of its rows, and their documents as 16-bit numbers or, where that is
    shorter, as a bitmap.

    A pair that a document links m times is in plane 0 of its pairs and, for every bit k of m - 1, in plane k + 1, which
    counts 2 ** k: so plane 0 is the bitmap of documents, and the planes together give the links.
    """
    if not links:
        return
    sizes = np.array([len(x) // 8 for x in links])
    keys = np.frombuffer(b"".join(links), np.int64).astype(np.uint64)
    keys <<= np.uint64(16)
    keys |= np.repeat(np.arange(len(links), dtype=np.uint64), sizes)
    keys.sort()
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    more = np.diff(np.append(at, len(keys))) - 1
    keys = keys[at]
    plane = 0
    while True:
        chosen = keys if plane == 0 else keys[(more >> (plane - 1)) & 1 == 1]
        if len(chosen):
            yield (plane, *_rows(chosen, len(links)))
        if not (more >> plane).any():
            return
        plane += 1


def _rows(keys: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Ids and documents of each pair of one plane, from sorted keys (pair, document)."""
    pair, doc = keys >> np.uint64(16), (keys & np.uint64(0xFFFF)).astype("<u2")
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    count = np.diff(np.append(first, len(pair)))
    wide = np.flatnonzero(count * 2 > (documents + 7) // 8)
    bits: list[bytes | None] = [None] * len(first)
    for k in wide.tolist():
        on = np.zeros(documents, np.uint8)
        on[doc[first[k] : first[k] + count[k]]] = 1
        bits[k] = np.packbits(on, bitorder="little").tobytes()
    slim = np.ones(len(first), bool)
    slim[wide] = False
    left = np.where(slim, count, 0)
    a = (pair[first] >> np.uint64(B_BITS)).astype(np.int32)
    b = (pair[first] & np.uint64((1 << B_BITS) - 1)).astype(np.int32)
    return a, b, _binaries(doc[np.repeat(slim, count)], np.cumsum(left) - left), pa.array(bits, pa.binary())


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_POSTINGS = "a int, b int, plane int, docs binary, bits binary"


def indexed(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", byte_path: str | None = None, piece_path: str | None = None, with_groups: bool = False) -> DataFrame:
    """One written table of two kinds of rows, both of a part of the input. Documents: part, doc (their number there), doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256 and, with ``with_groups``, groups. Postings: part, a, b, plane, docs, bits; their doc is null.

    Both come from the same tasks in one write, so that numbers and postings agree whatever is run again.
    """
    docs = only(documents, doc_id=doc_id, text=text).select(F.monotonically_increasing_id().alias("row"), "doc_id", utf8(F.col("text")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"part long, doc int, doc_id {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, groups_sha256 string, groups string, {_POSTINGS}"
    names = [x.split()[0] for x in schema.split(", ")]

    def batch_of(columns: dict[str, pa.Array], rows: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[n] if n in columns else pa.nulls(rows, t) for n, t in zip(names, kinds, strict=True)], names)

    def closed(part: int, links: list[bytes]) -> Iterator[pa.RecordBatch]:
        for plane, a, b, docs_, bits in postings(links):
            whole = batch_of({"part": pa.array(np.full(len(a), part), pa.int64()), "a": pa.array(a), "b": pa.array(b), "plane": pa.array(np.full(len(a), plane, np.int32)), "docs": docs_, "bits": bits}, len(a))
            for at in range(0, len(a), 20_000):
                yield whole.slice(at, 20_000)

    kinds: list[pa.DataType] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side, part, held, links = aligner(byte_path, piece_path), 0, 0, []
        for some in slices(batches, "text"):
            kinds[:] = [pa.int64(), pa.int32(), some.column(1).type, *[pa.int64()] * 4, pa.string(), pa.string(), *[pa.int32()] * 3, pa.binary(), pa.binary()]
            made = side.align([t.decode() for t in some.column(2).to_pylist()])
            parts, numbers, shown = [], [], []
            for row, found in zip(some.column(0).to_pylist(), made, strict=True):
                if links and (held + len(found[4]) // 8 > PART_LINKS or len(links) == PART_DOCS):
                    yield from closed(part, links)
                    held, links = 0, []
                if not links:
                    part = row
                parts.append(part)
                numbers.append(len(links))
                links.append(found[4])
                held += len(found[4]) // 8
                shown.append(hashlib.sha256(found[3].encode()).hexdigest() if found[3] else "")
            columns = {
                "part": pa.array(parts, pa.int64()), "doc": pa.array(numbers, pa.int32()), "doc_id": some.column(1), "groups_sha256": pa.array(shown, pa.string()),
                **{n: pa.array([f[k] for f in made], pa.int64()) for k, n in enumerate(_COUNTS[:3])},
                "n_links": pa.array([len(f[4]) // 8 for f in made], pa.int64()),
            }
            if with_groups:
                columns["groups"] = pa.array([f[3] for f in made], pa.string())
            yield batch_of(columns, some.num_rows)
        yield from closed(part, links)

    return cut(docs.mapInArrow(run, schema))


def pair_counts(index: DataFrame) -> DataFrame:
    """a, b, documents and links of every id pair of an index (or of several in one table): how many documents link it, and how many links there are.

    Parts hold different documents, so the bitmaps of a pair, each in the range of its part, are merged by OR without any overlap, and popcounts add up.
    """
    ones = F.coalesce(F.bitmap_count("bits"), F.lit(0)) + F.coalesce((F.octet_length("docs") / 2).cast("long"), F.lit(0))
    found = index.filter("a IS NOT NULL").select("a", "b", "plane", ones.alias("ones"))
    weight = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.col("plane") - 1, F.lit(0)))
    return found.groupBy("a", "b").agg(F.sum(F.when(F.col("plane") == 0, F.col("ones")).otherwise(0)).alias("documents"), F.sum(F.col("ones") * weight).alias("links"))


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums for each document of a part; the postings of a task come sorted by part."""
    names = ["part", "doc", "n_best", "count_sum"]
    part, best, total = None, np.zeros(PART_DOCS, np.int64), np.zeros(PART_DOCS, np.int64)

    def closed() -> pa.RecordBatch:
        at = np.flatnonzero(total)
        out = pa.RecordBatch.from_arrays([pa.array(np.full(len(at), part), pa.int64()), pa.array(at.astype(np.int32)), pa.array(best[at]), pa.array(total[at])], names)
        best[:], total[:] = 0, 0
        return out

    def add(docs: np.ndarray, weight: np.ndarray, links: np.ndarray, is_best: np.ndarray) -> None:
        np.add.at(total, docs, weight * links)
        np.add.at(best, docs, weight * is_best)

    for batch in batches:
        parts = batch.column(0).to_numpy()
        first = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])).tolist()
        for start, stop in zip(first, [*first[1:], len(parts)], strict=True):
            if part is not None and part != parts[start]:
                yield closed()
            part = parts[start]
            some = batch.slice(start, stop - start)
            plane, links, is_best = (some.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 4, 5))
            weight = np.int64(1) << np.maximum(plane - 1, 0)
            sizes = some.column(2).to_pylist()
            counts = np.array([len(x) // 2 for x in sizes])
            docs = np.frombuffer(b"".join(sizes), "<u2")
            add(docs, np.repeat(weight, counts), np.repeat(links, counts), np.repeat(is_best, counts))
            for k, data in enumerate(some.column(3).to_pylist()):
                if data is not None:
                    on = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little"))
                    total[on] += weight[k] * links[k]
                    best[on] += weight[k] * is_best[k]
    if part is not None:
        yield closed()


def align(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", byte_path: str | None = None, piece_path: str | None = None, with_groups: bool = True
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, with ``with_groups``, groups of every whole text.

    A: a space and the text in the byte-level vocabulary; B: the text in the piece vocabulary, which puts that space itself. Where tokens of both end at
    one byte, a group ends: ``groups`` lists the ids, ``a1,a2|b1;a3|b2,b3``. Links are the pairs of an A and a B token that share a byte. A pair's count are its
    links in all documents; ``count_sum`` adds the counts of a document's links, and ``n_best`` are those whose count is the highest of any pair with their B id, ties included.

    A null or empty text, and one whose tokens do not give its bytes back, has no tokens, zeros and an empty digest. Repeated rows are documents of their own and
    count each time; a null doc_id is kept. Other columns are ignored, an empty table gives no rows.
    """
    index = indexed(documents, doc_id, text, byte_path, piece_path, with_groups)
    # Written out, so that both sides of the join are plain exchanges and the postings of a pair found everywhere can be split.
    counts = cut(pair_counts(index).select("a", "b", "links"))
    highest = counts.groupBy("b").agg(F.max("links").alias("most"))
    scores = cut(counts.join(highest, "b").select("a", "b", "links", (F.col("links") == F.col("most")).alias("is_best")))
    sent = index.filter("a IS NOT NULL").select("part", "a", "b", "plane", "docs", "bits").join(scores, ["a", "b"])
    sent = sent.select("part", "plane", "docs", "bits", "links", "is_best").repartition("part").sortWithinPartitions("part")
    returned = sent.mapInArrow(_returned, "part long, doc int, n_best long, count_sum long")
    zero = F.lit(0).cast("long")
    out = index.filter("doc IS NOT NULL").join(cut(returned), ["part", "doc"], "left")
    return out.select(
        "doc_id", *_COUNTS, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", *["groups"] * with_groups
    )
