"""Spelling variants: the vocabulary's minimal acceptor, composed with a one-edit transducer and the acceptor again."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import only, slices, utf8
from larder.session import cut, drop_cut

MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: Of the hashes of document and run, those this number divides lose a code point.
ERROR_RATE = 31
LETTERS = "A-Za-zÀ-ÿ"
#: Different words a task counts before it passes them on.
HELD_WORDS = 200_000
#: A partition of more words than this is dealt out as pairs of tiles of half the size.
TILE = 40_000
#: Words of partitions that a task is given, on average.
TASK_WORDS = 20_000


def vocabulary(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, error_rate: int = ERROR_RATE) -> DataFrame:
    """word and n, its occurrences: maximal runs of letters of whole texts with A-Z in lower case, of which one in ``error_rate`` (by the CRC-32 of
    ``<doc_id>:<run>``; null doc_id: empty) has lost the code point whose place is that hash modulo its length."""
    docs = only(documents, doc_id=doc_id, text=text).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), utf8(F.col("text")).alias("text"))
    # A maximal run of enough letters: a match starts where its run starts, as a run that is too short for it is passed over whole.
    runs = re.compile(f"[{LETTERS}]{{{min_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        crc = zlib.crc32

        def closed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for some in slices(batches, "text"):
            for name, data in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                start = crc(f"{name}:".encode())
                for word, n in Counter(runs.findall(data.lower().decode())).items():  # of bytes: only A-Z are lowered
                    hashed = crc(word.encode(), start)
                    if hashed % error_rate == 0:
                        k = hashed % len(word)
                        word = word[:k] + word[k + 1 :]
                        if len(word) < min_length:
                            continue
                    held[word] = held.get(word, 0) + n
            if len(held) > HELD_WORDS:
                yield closed()
        if held:
            yield closed()

    return docs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class Acceptor:
    """The minimal automaton of sorted words, built one word after another: states with equal continuations are one state, so a state is its right language.

    A state's words are ranked in their order: that which ends there is the first, those behind a symbol follow at its offset. ``out`` are the
    transitions (symbol to state and offset), ``count``, ``low`` and ``high`` the number of words and their least and largest length.
    """

    def __init__(self, words: list[str]) -> None:
        self.out: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.count: list[int] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self._known: dict[tuple, int] = {}
        path: list[list] = [[{}, False]]
        last = ""
        for word in words:
            common = 0
            for x, y in zip(last, word, strict=False):
                if x != y:
                    break
                common += 1
            self._close(path, last, common)
            path += [[{}, False] for _ in word[common:]]
            path[-1][1] = True
            last = word
        self._close(path, last, 0)
        self.start = self._state(*path[0])
        self._known.clear()

    def _close(self, path: list[list], word: str, depth: int) -> None:
        while len(path) > depth + 1:
            target = self._state(*path.pop())
            path[-1][0][word[len(path) - 1]] = target

    def _state(self, targets: dict[str, int], final: bool) -> int:
        key = (final, *targets.items())
        found = self._known.get(key)
        if found is None:
            found = self._known[key] = len(self.out)
            at, out = int(final), {}
            for symbol, target in targets.items():
                out[symbol] = (target, at)
                at += self.count[target]
            self.out.append(out)
            self.final.append(final)
            self.count.append(at)
            self.low.append(0 if final else min((self.low[t] + 1 for t in targets.values()), default=0))
            self.high.append(max((self.high[t] + 1 for t in targets.values()), default=0))
        return found


class Composition:
    """Acceptor, one-edit transducer, acceptor: the pairs of accepted words that differ by one replaced or one deleted code point.

    Before the edit both copies of the acceptor are in one state, as they read the same symbols and are deterministic; after it they read the same symbols from two
    states, and what both accept is the intersection of their right languages. Results hang on states alone, so words that end alike share them. A pair of
    ranks is one number, the first in the high half; behind a transition both ranks grow by its offset.
    """

    def __init__(self, words: Acceptor) -> None:
        self.words = words
        self._both: dict[tuple[int, int], list[int]] = {}

    def both(self, p: int, q: int) -> list[int]:
        """Ranks in both states of what both accept."""
        words, known = self.words, self._both
        low, high = words.low, words.high
        stack = [(p, q)]
        while stack:
            key = stack[-1]
            if key in known:
                stack.pop()
                continue
            one, two = key
            if one == two:
                known[key] = [k << 32 | k for k in range(words.count[one])]
                continue
            left, right = words.out[one], words.out[two]
            met, waiting = [], False
            for symbol in left if len(left) <= len(right) else right:
                if symbol in left and symbol in right:
                    (x, a), (y, b) = left[symbol], right[symbol]
                    if low[x] <= high[y] and low[y] <= high[x]:
                        below = known.get((x, y))
                        if below is None:
                            stack.append((x, y))
                            waiting = True
                        elif below:
                            met.append((a << 32 | b, below))
            if waiting:
                continue
            if words.final[one] and words.final[two]:
                found = [0]
            elif len(met) == 1 and met[0][0] == 0:
                found = met.pop()[1]
            else:
                found = []
            for base, below in met:
                found += [base + k for k in below]
            known[key] = found
        return known[p, q]

    def pairs(self) -> np.ndarray:
        """Every pair of ranks once, as rows: of a deletion the shorter word second, of a replacement the smaller word first. States come after those that
        they lead to, as they were made, so there is no recursion as deep as a word."""
        words = self.words
        low, high = words.low, words.high
        of_state: list[list[int]] = []
        for q, out in enumerate(words.out):
            parts: list[tuple[int, list[int]]] = []
            edges = list(out.items())
            for k, (_, (target, at)) in enumerate(edges):
                if of_state[target]:
                    parts.append((at << 32 | at, of_state[target]))
                # Deleted here: of a run of equal symbols the last one, so that the rest does not start with it.
                if low[target] <= high[q] and low[q] <= high[target]:
                    end = at + words.count[target]
                    gone = [pair for pair in self.both(target, q) if not at <= pair & 0xFFFFFFFF < end]
                    if gone:
                        parts.append((at << 32, gone))
                for _, (right, there) in edges[k + 1 :]:
                    if low[target] <= high[right] and low[right] <= high[target]:
                        same = self.both(target, right)
                        if same:
                            parts.append((at << 32 | there, same))
            if len(parts) == 1 and parts[0][0] == 0:
                of_state.append(parts[0][1])
            else:
                of_state.append([base + pair for base, some in parts for pair in some])
        made = np.array(of_state[words.start], np.int64)
        return np.stack([made >> 32, made & 0xFFFFFFFF], axis=1)


def _group(side: int, edge: int, words: list[str], counts: list[int], tiles: list[int], across: bool) -> pa.RecordBatch:
    """word, near words, largest n of them and the smallest word of that n, for the words of one partition that have near words.

    Forward partitions hold words that start alike, and find the edits behind that start; backward ones hold words that end alike, reversed, and find the edits in
    the first ``edge`` symbols: pairs that also start alike are left to the others. Of two tiles only pairs across them count.
    """
    pairs = Composition(Acceptor([w[edge:] for w in words])).pairs()
    if across and len(pairs):
        tile = np.array(tiles)
        pairs = pairs[tile[pairs[:, 0]] != tile[pairs[:, 1]]]
    if side and len(pairs):
        starts = [w[: -edge - 1 : -1] for w in words]
        pairs = pairs[[starts[x] != starts[y] for x, y in pairs.tolist()]]
    both = np.concatenate([pairs, pairs[:, ::-1]])
    shown = [w[::-1] for w in words] if side else words
    order = {w: k for k, w in enumerate(sorted(shown))}
    place, number = np.array([order[w] for w in shown], np.int64), np.array(counts, np.int64)
    both = both[np.lexsort((place[both[:, 1]], -number[both[:, 1]], both[:, 0]))]
    first = np.flatnonzero(np.append(True, both[1:, 0] != both[:-1, 0])) if len(both) else np.empty(0, np.int64)
    best = both[first]
    near = np.diff(np.append(first, len(both)))
    columns = [
        pa.array([shown[k] for k in best[:, 0].tolist()], pa.string()), pa.array(near, pa.int64()), pa.array(number[best[:, 1]], pa.int64()),
        pa.array([shown[k] for k in best[:, 1].tolist()], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["word", "near", "n", "name"])


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, tile: int = TILE) -> DataFrame:
    """word, n_near (near words) and best (struct of -n and word: its near word of largest n, the smallest of ties) of the words that have any.

    ``words`` are word and n, each word once and of ``min_length`` code points at least. The composition is split by the state that its first symbols lead to: of two near words either the first
    ``(min_length - 1) // 2`` symbols agree or, the edit being there, the last as many do, which the same composition finds on reversed words.
    """
    edge = max(0, (min_length - 1) // 2)
    forward = F.struct(F.lit(0).alias("side"), F.substring("word", 1, edge).alias("start"), F.col("word").alias("form"))
    backward = F.struct(F.lit(1).alias("side"), F.substring(F.reverse("word"), 1, edge).alias("start"), F.reverse("word").alias("form"))
    keyed = words.select("n", F.explode(F.array(forward, backward) if edge else F.array(forward)).alias("k")).select("k.*", "n")
    sizes = cut(keyed.groupBy("side", "start").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
    keyed = cut(keyed).join(sizes, ["side", "start"])
    tiles = F.ceil(F.col("size") / (tile // 2)).cast("int")
    own = F.pmod(F.xxhash64("form"), tiles).cast("int")
    usual = keyed.filter(F.col("size") <= tile).select("side", "start", F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(0).alias("own"), "form", "n")
    met = F.transform(F.sequence(F.lit(0), tiles - 1), lambda t: F.struct(F.least(t, own).alias("low"), F.greatest(t, own).alias("high"), own.alias("own")))
    large = keyed.filter(F.col("size") > tile).select("side", "start", F.explode(met).alias("t"), "form", "n").select("side", "start", "t.*", "form", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        form: list[str] = []
        counts: list[int] = []
        owns: list[int] = []

        def closed() -> Iterator[pa.RecordBatch]:
            if key is None or len(form) < 2:
                return
            made = _group(key[0], edge, form, counts, owns, key[2] != key[3])
            for at in range(0, made.num_rows, 10_000):
                yield made.slice(at, 10_000)

        for batch in batches:
            side, start, low, high = (batch.column(k).to_pylist() for k in range(4))
            keys = list(zip(side, start, low, high, strict=True))
            cuts = [0, *[k for k in range(1, len(keys)) if keys[k] != keys[k - 1]], len(keys)]
            own_, form_, n_ = (batch.column(k).to_pylist() for k in (4, 5, 6))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if keys[a] != key:
                    yield from closed()
                    key, form, counts, owns = keys[a], [], [], []
                form += form_[a:b]
                counts += n_[a:b]
                owns += own_[a:b]
        yield from closed()

    by = ["side", "start", "low", "high"]
    # The work on a word is far more than its bytes tell, so the tasks follow the number of words.
    tasks = max(1, -(-sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] // TASK_WORDS))
    found = usual.unionByName(large).repartition(tasks, *by).sortWithinPartitions(*by, "form").mapInArrow(run, "word string, near long, n long, name string")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("name").alias("word"))).alias("best"))


def variants(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, error_rate: int = ERROR_RATE, tile: int = TILE
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary.

    Near are two words that differ by exactly one inserted, deleted or replaced code point. ``form`` is the near word of largest n, of ties the smallest in code-point order, if
    that n is ``ratio`` times the word's or more, else null; ``form_n`` is its n. ``root`` is where following forms ends, the word itself if it has none: each step multiplies n by ``ratio`` (2 or more), so
    there is no circle. Null and empty texts have no words, repeated rows count each time, other columns are ignored, an empty table gives no rows.
    """
    words = cut(vocabulary(documents, doc_id, text, min_length, min_count, error_rate))
    near = near_words(words, min_length, tile)
    far = F.when(-F.col("best.less") >= F.col("n") * ratio, F.col("best"))
    known = cut(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), far["word"].alias("form"), (-far["less"]).alias("form_n")
        )
    )
    # Roots by doubling: after round k a word knows the one 2 ** k forms on. n grows by the ratio with every form, so the rounds are few.
    jumps = cut(known.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if jumps.join(ahead, "root", "left_semi").isEmpty():
            break
        further = cut(jumps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
        drop_cut(jumps)
        jumps = further
    return known.join(jumps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
