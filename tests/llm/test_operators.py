"""Each operator against a brute-force version, and on nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from larder.llm import chat, chunk_bpe, classifier, fm_index, license_rules, licenses, nn_descent, packing, quality, sharding, simhash, substrings
from larder.llm.bpe import WordEncoder, encoder, vocabulary_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHES = ["row", "node", "fp", "text_key", "kept", "size", "shard", "slot", "ids", "tokens", "queue", "anchor", "mask", "u", "v", "n", "key", "cell", "component", "record", "shift", "start", "pair", "label", "order"]
SPACE = "\t\n\x0b\x0c\r "


def words(text):
    return (text or "").encode().split()


def corpus():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage, base = say(60), say(120).split()
    texts = [None, "", "  \n\t ", "one", "two words", "Straße Ünïcode ﬁ ẞ İ 😀 中文", "x" * 3000, say(9000)]
    texts += [f"{say(30)}\n{passage} {say(25)}" for _ in range(6)]
    texts += [" ".join(base)] * 4
    for _ in range(6):
        near = list(base)
        near[rng.randrange(120)] = rng.choice(vocabulary)
        texts.append(" ".join(near))
    texts += [say(rng.randint(1, 200)) for _ in range(30)]
    texts += ["Re. " * 50, f"{passage} {passage}", "Licensed under the MIT License. mit license\nApache license 2.0", "a b c " * 40, "%%% ### " * 30]
    return [(k, t, "en", [None, "hot", "hot", f"s{k % 5}"][k % 4], len(t or "")) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    found = corpus()
    return found + [found[-1], found[-1], (None, "a document without a name " * 4, "en", "hot", 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    out = spark.createDataFrame(rows, DOCS).repartition(3)
    return out.withColumns({name: F.lit("clash") for name in CLASHES}).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# Packing


def check_pieces(found, expected, sequence):
    by = defaultdict(list)
    for r in found:
        by[r.sequence_id].append(r)
    assert sorted(by) == list(range(len(by)))
    for k, pieces in by.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == sequence or k == len(by) - 1
    whole = defaultdict(list)
    for r in found:
        whole[r.doc_id].append(r)
    got = Counter()
    for key, pieces in whole.items():
        # Copies of a repeated row have the same pieces' ids, so their ids are compared as a multiset of positions.
        ids = Counter()
        for p in pieces:
            ids.update(enumerate(np.frombuffer(p.ids, "<u4").tolist(), p.start))
        got[key] = ids
    for key, lists in expected.items():
        want = Counter()
        for ids in lists:
            want.update(enumerate(ids))
        assert got[key] == want
    assert set(got) == set(expected)


def test_packing_places_every_id_once(docs, rows):
    words_ = encoder()
    expected = defaultdict(list)
    for doc_id, text, *_ in rows:
        expected[doc_id].append([*words_.encode((text or "").encode()).tolist(), 1])
    check_pieces(packing.pack(docs).collect(), expected, 2048)
    check_pieces(packing.pack(docs, sequence=64, packet=16).collect(), expected, 64)


def test_packing_holds_the_mixture(spark):
    rows = [(k, "word " * 40, "en", "big" if k % 4 else f"small{k % 3}", 0) for k in range(400)]
    found = packing.pack(spark.createDataFrame(rows, DOCS), sequence=128, packet=32).collect()
    source = {r[0]: r[3] for r in rows}
    total, sequences = Counter(), max(r.sequence_id for r in found) + 1
    running = defaultdict(lambda: [0] * sequences)
    for r in found:
        total[source[r.doc_id]] += r.length
        running[source[r.doc_id]][r.sequence_id] += r.length
    everything = sum(total.values())
    for name, each in running.items():
        share = total[name] / everything
        # Half a packet of its own, its share of the half packets by which the other queues shift a sequence's end, and its quantum of
        # the round that the sequence ends in, which it has had or not.
        allowed = 16 + share * 16 * len(total) + share * 128
        assert np.abs(np.cumsum(each)[:-1] - share * 128 * np.arange(1, sequences)).max() <= allowed


def round_robin(queues, sequence, packet, targets=None):
    """Pieces of a plainly run deficit round-robin: in each round every queue that has tokens gets its quantum, sends head packets while its
    credit covers half of the next one, and carries the rest. ``queues`` are lists of (row, tokens) by name."""
    packets = {q: [(row, a, min(packet, n - a)) for row, n in rows for a in range(0, n, packet)] for q, rows in queues.items()}
    left = {q: sum(p[2] for p in ps) for q, ps in packets.items()}
    whole = sum(left.values())
    rounds = max(1, -(-whole // sequence))
    rate = {q: (left[q] if targets is None else targets[q]) for q in queues}
    credit, sent, stream = dict.fromkeys(queues, 0.0), dict.fromkeys(queues, 0.0), []
    for _ in range(rounds):
        budget = whole / rounds
        # What a queue cannot use goes to the others in proportion.
        while budget > 1e-9:
            live = [q for q in queues if left[q] > 1e-9]
            if not live:
                break
            step = min(budget, *[left[q] * sum(rate[x] for x in live) / rate[q] for q in live])
            for q in live:
                part = step * rate[q] / sum(rate[x] for x in live)
                credit[q] += part
                left[q] -= part
            budget -= step
        for q in sorted(queues):
            while packets[q] and credit[q] - sent[q] >= packets[q][0][2] / 2 - 1e-6:
                stream.append(packets[q].pop(0))
                sent[q] += stream[-1][2]
    assert not any(packets.values())
    pieces, at = [], 0
    for row, start, n in stream:
        while n:
            room = min(n, sequence - at % sequence)
            pieces.append((row, start, room, at // sequence, at % sequence))
            start, n, at = start + room, n - room, at + room
    return sorted(pieces)


@pytest.mark.parametrize("targets", [None, {"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 0.1, "b": 0.1, "c": 0.8}])
def test_packing_is_a_plain_deficit_round_robin(spark, targets):
    """Also under targets that let queues run dry one after another."""
    rng = random.Random(3)
    rows = [(k, rng.choices("abc", weights=[6, 3, 1])[0], rng.randint(1, 90)) for k in range(300)]
    table = spark.createDataFrame([(k, f"={q}", n) for k, q, n in rows], "row long, queue string, tokens long").repartition(4)
    found = packing.layout(table, 64, 16, targets).select("row", "start", "length", "sequence_id", "offset").collect()
    queues = {q: [(k, n) for k, x, n in rows if x == q] for q in "abc"}
    assert sorted(map(tuple, found)) == round_robin(queues, 64, 16, targets)


def test_packing_follows_targets(spark):
    """A scarce source is used up first; sources without a target share the rest, or wait where there is none."""
    rows = [(k, "word " * 30, "en", ["scarce", "big", None, "other"][min(3, k % 8)], 0) for k in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    source = {r[0]: r[3] for r in rows}

    def mixture(targets):
        found = packing.pack(docs, sequence=128, packet=16, targets=targets).collect()
        assert sum(r.length for r in found) == 400 * 31
        by = defaultdict(Counter)
        for r in found:
            by[r.sequence_id][source[r.doc_id]] += r.length
        return by

    half = mixture({"scarce": 0.5, None: 0.25})
    first = sum((half[k] for k in range(20)), Counter())
    assert first["scarce"] / 2560 == pytest.approx(0.5, abs=0.02) and first[None] / 2560 == pytest.approx(0.25, abs=0.02)
    assert first["other"] / first["big"] == pytest.approx(5, rel=0.15)
    whole = mixture({"scarce": 0.6, "big": 0.4, "absent": 1e-9})
    assert sum((whole[k] for k in range(20)), Counter()).keys() == {"scarce", "big"}
    assert not set(whole[max(whole)]) & {"scarce", "big"}
    with pytest.raises(ValueError, match="targets"):
        packing.pack(docs, targets={"scarce": 0.7, "big": 0.6})


def test_packing_does_not_depend_on_groups(spark, docs, monkeypatch):
    columns = ["row", "start", "length", "sequence_id", "offset"]
    lengths = spark.range(300).select((F.col("id") + (F.col("id") % 3) * 2**33).alias("row"), F.concat(F.lit("q"), F.col("id") % 7).alias("queue"), (F.col("id") % 90 + 1).alias("tokens"))
    one = sorted(packing.layout(lengths, 64, 16).select(columns).collect())
    monkeypatch.setattr(packing, "GROUP_PACKETS", 10)
    assert sorted(packing.layout(lengths, 64, 16).select(columns).collect()) == one


# Embeddings


def brute_links(rows, threshold=0.93):
    usable = [k for k, (_, e, label) in enumerate(rows) if label is not None and e and None not in e and np.isfinite(e).all() and any(e)]
    unit = {k: np.array(rows[k][1], np.float32).astype(float) / np.linalg.norm(np.array(rows[k][1], np.float32).astype(float)) for k in usable}
    near = defaultdict(set)
    for a in usable:
        for b in usable:
            if a != b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                near[a].add(b)
    label = {k: rows[k][0] for k in range(len(rows))}
    while True:
        new = {k: min([label[k], *(label[j] for j in near[k])]) for k in label}
        if new == label:
            return [(rows[k][0], len(near[k]), label[k]) for k in range(len(rows))]
        label = new


def vector_rows():
    rng = np.random.default_rng(3)
    rows = []
    for group, size in enumerate((90, 40, 3)):
        center = rng.standard_normal(16)
        rows += [((center + rng.standard_normal(16) * 0.1).tolist(), group % 2) for _ in range(size)]
    rows += [(rng.standard_normal(16).tolist(), k % 3) for k in range(150)]
    rows += [rows[0]] * 30 + [(rows[0][0], 7), (rows[0][0], None), (None, 1), ([], 1), ([0.0] * 16, 1), ([None] * 16, 1), ([float("nan")] * 16, 1), ([1.0] * 8, 0)]
    return [(k, e, label) for k, (e, label) in enumerate(rows)]


@pytest.mark.parametrize("k", [4, 16])
def test_links_equal_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(nn_descent, "TILE", 32)
    monkeypatch.setattr(nn_descent, "BLOCK", 32)
    rows = vector_rows()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit("clash") for c in CLASHES if c != "label"})
    found = nn_descent.near_duplicates(table, k=k).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == sorted(brute_links(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert {r.audited_recall for r in found} == {1.0}


def test_audit_sees_missing_links(spark):
    """Without a link the recall of a table that has links is 0: the audit does not ask the graph."""
    rows = [(k, [1.0, 0.001 * k, 0.0], 1) for k in range(20)]
    table, width = nn_descent.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), "vec_id", "embedding", "label")
    nodes = table.select(F.col("vec_id").alias("node"), F.lit(1).cast("long").alias("mult"), "cell", "vec")
    none = spark.createDataFrame([], "node long, links long")
    assert nn_descent._recall(none, nodes, width, 0.93) == 0.0
    all_found = nodes.select("node", F.lit(19).cast("long").alias("links"))
    assert nn_descent._recall(all_found, nodes, width, 0.93) == 1.0


def _nodes(spark, vectors):
    rows = [(k, v.tolist(), 1) for k, v in enumerate(vectors)]
    table, width = nn_descent.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), "vec_id", "embedding", "label")
    return table.select(F.col("vec_id").alias("node"), F.lit(1).cast("long").alias("mult"), "cell", "vec"), width


def test_audit_finds_rare_links(spark):
    """One pair among 3,000 vectors: most likely neither is drawn first, and yet its loss is seen."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((3000, 32))
    nodes, width = _nodes(spark, x)
    none = spark.createDataFrame([], "node long, links long")
    first = {r.node for r in nodes.orderBy(F.xxhash64("node"), "node").limit(nn_descent.AUDIT).collect()}
    a, b = [k for k in range(3000) if k not in first][:2]
    assert nn_descent._recall(none, nodes, width, 0.93) == 1.0  # all were compared
    x[b] = x[a] + 0.01
    nodes, width = _nodes(spark, x)
    assert nn_descent._recall(none, nodes, width, 0.93) == 0.0


def test_audit_is_not_outweighed_by_a_crowd(spark):
    """A crowd that has all of its links does not hide pairs that have none."""
    rng = np.random.default_rng(9)
    crowd, pairs = rng.standard_normal(32) + rng.standard_normal((400, 32)) * 0.01, rng.standard_normal((100, 32))
    nodes, width = _nodes(spark, np.concatenate([crowd, pairs, pairs + 0.01]))
    found = nodes.filter("node < 400").select("node", F.lit(399).cast("long").alias("links"))
    assert nn_descent._recall(found, nodes, width, 0.93, nodes.filter("node < 400").select("node")) == 0.0
    assert nn_descent._recall(found, nodes, width, 0.93) < 0.99


def test_lists_keep_far_neighbours(spark):
    """Vectors without close company have full lists, by which a twin is found."""
    x = np.random.default_rng(10).standard_normal((300, 32))
    nodes, width = _nodes(spark, x)
    graph = nn_descent.neighbour_graph(nodes, width, [0], 8).collect()
    assert len(graph) == 300 and all(len(r.near) == 8 for r in graph)


def test_missed_links_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "_recall", lambda *_: 0.5)
    monkeypatch.setattr(nn_descent, "ATTEMPTS", 0)
    with pytest.raises(RuntimeError, match="0.5"):
        nn_descent.near_duplicates(spark.createDataFrame([(1, [1.0, 2.0], 1)], "vec_id long, embedding array<float>, label int"))


def test_no_vectors(spark):
    assert nn_descent.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


# Quality


def slow_base(text):
    text = text or ""
    found = words(text)
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    windows = [tuple(found[k : k + 5]) for k in range(len(found) - 4)]
    twice = Counter(windows)
    cover = {k + j for k, w in enumerate(windows) if twice[w] > 1 for j in range(5)}
    return (
        len(found), sum(len(w.decode()) for w in found), sum(text.count(c) for c in "#*$%&|<>"),
        sum(line in lines[:k] for k, line in enumerate(lines)), len(cover),
    )


def test_base_counts(docs, rows):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = quality.score(docs, np.zeros(1 << quality.BITS, np.float32)).collect()
    assert sorted((str(r.doc_id), *(r[n] for n in names)) for r in found) == sorted((str(r[0]), *slow_base(r[1])) for r in rows)
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed)


def test_ratio_separates_target_and_rest(spark):
    rng = random.Random(1)
    good = [" ".join(rng.choices(["lorem", "ipsum", "dolor", "amet", "sit", "elit"], k=50)) for _ in range(80)]
    bad = [" ".join(rng.choices(["buy", "cheap", "now", "click", "win", "free"], k=50)) for _ in range(40)]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(good + bad)], DOCS)
    labels = spark.createDataFrame([(k, int(k < 80), 0) for k in range(0, 120, 2)] + [(None, 1, 0), (0, None, 0), (0, 1, 0)], "doc_id long, quality int, toxic int")
    ratio = quality.fit_ratio(docs, labels)
    raw = np.bincount(np.concatenate([quality.hashed_ngrams(t.encode(), quality.BITS) for t in good + bad]), minlength=1 << quality.BITS)
    target = np.bincount(np.concatenate([quality.hashed_ngrams(good[k].encode(), quality.BITS) for k in range(0, 80, 2)]), minlength=1 << quality.BITS)
    share = target.sum() / raw.sum()
    assert np.allclose(ratio, np.log((target + 20 * share) / ((raw + 20) * share)), atol=1e-6)
    scores = {r.doc_id: r.ratio for r in quality.score(docs, ratio).collect()}
    assert min(scores[k] for k in range(80)) > 0 > max(scores[k] for k in range(80, 120))


def test_no_labels_reject_nothing_by_ratio(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert not quality.fit_ratio(docs, labels).any()
    assert quality.kept_documents(docs, labels).columns == docs.columns


# SimHash


def slow_fingerprint(text):
    found = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words(text)]
    shingles = [b" ".join(found[k : k + 3]) for k in range(len(found) - 2)] or ([b" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_groups(docs, rows):
    fps = [slow_fingerprint(r[1]) for r in rows]
    label = [r[0] for r in rows]
    named = [k for k, r in enumerate(rows) if r[0] is not None]
    while True:
        new = {k: min(label[j] for j in named if (fps[k] ^ fps[j]).bit_count() <= 3) for k in named}
        if all(label[k] == new[k] for k in named):
            break
        for k in named:
            label[k] = new[k]
    found = simhash.near_duplicates(docs).collect()
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found if r.doc_id is not None)
    assert got == sorted((str(rows[k][0]), f"{fps[k]:016x}", str(label[k])) for k in named)
    kept = simhash.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({label[k] for k in named})


@pytest.mark.parametrize("tile", [4, 16, 2048])
def test_every_close_pair_is_connected(spark, monkeypatch, tile):
    """Also where buckets are dealt out as pairs of tiles."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(2)
    centers = [rng.getrandbits(64) for _ in range(6)]
    fps = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centers for _ in range(25)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f, k) for k, f in enumerate(signed)], "fp long, node long")
    edges = simhash.links(nodes).collect()

    def components(pairs):
        label = list(range(len(fps)))
        changed = True
        while changed:
            changed = False
            for a, b in pairs:
                low = min(label[a], label[b])
                changed |= label[a] != low or label[b] != low
                label[a] = label[b] = low
        return label

    close = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3]
    assert components([(e.u, e.v) for e in edges]) == components(close)


def test_masks_keep_a_block_choice_for_any_three_bits():
    rng = random.Random(0)
    for _ in range(2000):
        difference = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not difference & m for m in simhash.masks())


# Licences


def slow_base_phrases(text):
    lower = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).decode()
    found = "".join(c if c >= "\x80" or c.isdigit() or c.isalpha() else " " for c in lower).split(" ")
    found = [w for w in found if w]
    places = [(k, label) for label, phrase in license_rules.BASE for k in range(len(found)) if found[k : k + len(phrase.split())] == phrase.split()]
    return len(found), len(places), min((p[0] for p in places), default=None), max((p[0] for p in places), default=None), ",".join(sorted({p[1] for p in places}))


LICENSED = [
    "MIT License MIT license, mit-license", "GNU General Public License, version 3 or the Apache License, Version 2.0",
    "the submit license and mit licenses", "general public\nlicense general PUBLIC license", "mit license " * 300, "éMIT License é mit license",
    "SPDX-License-Identifier: MIT", "Licensed under CC BY-NC 4.0.", "GNU Lesser General Public License v2.1", "no terms at all",
]


def test_license_phrases(spark, rows):
    texts = [*LICENSED, *[r[1] for r in rows]]
    table = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, labels string")
    found = {r.doc_id: r for r in licenses.scan(table).collect()}
    for k, t in enumerate(texts):
        r = found[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == slow_base_phrases(t), t
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1
    assert found[1].labels == "apache,apache-2.0,gpl,gpl-3.0"
    assert found[6].labels == "mit" and found[7].labels == "cc-by-nc"
    assert found[8].labels == "gpl,lgpl-2.1"


def test_suppression_by_sweep_and_by_window_agree(spark):
    table = spark.createDataFrame(list(enumerate(LICENSED)), "doc_id long, text string")
    scanned = licenses.scan(table).cache()
    left = defaultdict(set)
    for r in licenses.detections(scanned).collect():
        left[r.doc_id].add(r.label)
    for r in scanned.collect():
        hits = [h for h in r.hits]
        # Brute force: a hit is hidden if one of the same or a higher priority covers it and comes before it in the order of ties.
        rank = lambda h: (h.start, -h.stop, h.level, h.rule)
        shown = {h.label for h in hits if not any(g.start <= h.start and g.stop >= h.stop and g.level <= h.level and rank(g) < rank(h) for g in hits)}
        assert left[r.doc_id] == shown
        assert set(filter(None, r.labels.split(","))) == shown | set(filter(None, r.base_labels.split(",")))


def _matching(items):
    """Texts that an expression matches: all choices of alternatives, optional parts with and without, repeats at their fewest."""
    from re import _constants as c

    out = [""]
    for kind, value in items:
        if kind is c.LITERAL:
            parts = [chr(value)]
        elif kind is c.SUBPATTERN:
            parts = _matching(value[-1])
        elif kind is c.BRANCH:
            parts = [t for branch in value[1] for t in _matching(branch)]
        elif kind is c.MAX_REPEAT:
            low, high, what = value
            parts = [t * low for t in _matching(what)] + (_matching(what) if low == 0 else [])
        elif kind is c.IN:
            parts = [chr(v) for k, v in value if k is c.LITERAL] + [chr(v[0]) for k, v in value if k is c.RANGE] or ["x"]
        else:
            raise AssertionError(kind)
        out = [a + b for a in out for b in dict.fromkeys(parts)]
    return out


def test_every_rule_fires_on_each_of_its_alternatives(spark):
    from re import _parser

    want = [(k, t) for k, r in enumerate(license_rules.rules()) for t in dict.fromkeys(_matching(_parser.parse(r.regex)))]
    table = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(want)], "doc_id long, text string").repartition(4)
    found = {r.doc_id: {h.rule for h in r.hits} for r in licenses.scan(table).select("doc_id", "hits").collect()}
    assert [(license_rules.rules()[k].label, t) for i, (k, t) in enumerate(want) if k not in found[i]] == []


def test_notices_without_the_word_licence(spark):
    texts = {
        "Neither the name of the Foo Project nor the names of its contributors may be used to endorse or promote products": "bsd-3-clause",
        "All advertising materials mentioning features or use of this software must display the following": "bsd-4-clause",
        "Unauthorized copying of this file, via any medium, is strictly prohibited": "proprietary",
        "BSD 3-Clause": "bsd-3-clause", "two clause BSD": "bsd-2-clause", "Datenlizenz Deutschland Namensnennung 2.0": "dl-de-by-2.0",
        "All rights reserved.": "all-rights-reserved", "licensed under Apache v2": "apache-2.0", "licensed under the Apache v 2.0": "apache-2.0",
    }
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.labels for r in licenses.scan(table).collect()} == dict(enumerate(texts.values()))


def test_rules_compile_and_are_many():
    import re

    found = license_rules.rules()
    assert len(found) > 250
    for r in found:
        re.compile(r.regex)
        assert r.gate in license_rules.GATES and 0 <= r.level < licenses.LEVELS


# Substrings


def slow_removal(texts, window):
    count = Counter(tuple(w[k : k + window]) for w in map(words, texts) for k in range(len(w) - window + 1))
    out = []
    for w in map(words, texts):
        gone = {k + j for k in range(len(w) - window + 1) if count[tuple(w[k : k + window])] > 1 for j in range(window)}
        out.append([x for k, x in enumerate(w) if k not in gone])
    return out


@pytest.mark.parametrize("hot", [8192, 1])
def test_repeated_windows_go(docs, rows, monkeypatch, hot):
    """Also where an anchor's passages are dealt out by windows, over many shards."""
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 500)
    left = slow_removal([r[1] for r in rows], 35)
    want = sorted((str(r[0]), len(words(r[1])), len(words(r[1])) - len(x), hashlib.sha256(b" ".join(x)).hexdigest()) for r, x in zip(rows, left, strict=True))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(docs).collect()) == want
    assert any(w[2] for w in want) and any(not w[2] for w in want)


def test_cleaned_documents_keep_rows_and_columns(docs, rows):
    cleaned = substrings.cleaned_documents(docs)
    assert cleaned.columns == docs.columns
    left = slow_removal([r[1] for r in rows], 35)
    want = [(str(r[0]), b" ".join(x).decode() if len(x) < len(words(r[1])) else r[1]) for r, x in zip(rows, left, strict=True)]
    assert sorted(map(str, ((str(r.doc_id), r.text) for r in cleaned.collect()))) == sorted(map(str, want))


def test_passages_hold_every_window_once():
    rng = random.Random(4)
    for n in (0, 34, 35, 36, 500):
        found = [str(rng.randrange(6)).encode() for _ in range(n)]
        _, _, start, count = substrings.passages(found)
        assert [k for a, c in zip(start, count, strict=True) for k in range(a, a + c)] == list(range(max(0, n - 34)))
        assert all(0 < c <= 28 for c in count)


def test_backward_search_counts_every_pattern():
    rng = np.random.default_rng(8)
    text = rng.integers(0, 5, 400)
    index = fm_index.FMIndex(text, 6)
    for _ in range(300):
        pattern = rng.integers(1, 5, rng.integers(1, 7))
        low, high = np.array([0]), np.array([index.size])
        for symbol in pattern[::-1]:
            low, high = index.extend(np.array([symbol]), low, high)
        there = sum((text[k : k + len(pattern)] == pattern).all() for k in range(len(text) - len(pattern) + 1))
        assert max(0, int(high[0] - low[0])) == there


def test_matching_lengths_equal_brute_force():
    rng = np.random.default_rng(9)
    text = rng.integers(0, 4, 200)
    heavy = rng.random(200) < 0.1
    index = fm_index.FMIndex(text, 8)
    found = fm_index.matching_lengths(index, text, np.arange(200), 8, heavy)
    for end in range(200):
        best = 0
        for n in range(1, min(8, end + 1) + 1):
            run = text[end - n + 1 : end + 1]
            if (run == 0).any():
                break
            at = [k for k in range(200 - n + 1) if (text[k : k + n] == run).all()]
            if len(at) + sum(bool(heavy[k]) for k in at) < 2:
                break
            best = n
        assert found[end] == best


# Classifier


def test_classifier_learns_on_rows_it_did_not_see(spark):
    rng = random.Random(6)
    good, bad = ["lorem", "ipsum", "dolor", "amet", "sit", "elit", "the", "of"], ["buy", "cheap", "now", "click", "win", "free", "the", "of"]
    texts = [" ".join(rng.choices(good if k % 3 else bad, k=rng.randint(5, 80))) for k in range(600)]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], DOCS)
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(600)], "doc_id long, quality int, toxic int")
    found = classifier.classify(docs, labels).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {k for k in range(600) if zlib.crc32(str(k).encode()) % 4 == 2}
    assert sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) / len(held) > 0.97
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in found)


def plain_ftrl(examples):
    """FTRL-proximal as published, one coordinate after another."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= classifier.L1:
            return 0.0
        sign = 1.0 if z[i] > 0 else -1.0
        return -(z[i] - sign * classifier.L1) / ((classifier.BETA + n[i] ** 0.5) / classifier.ALPHA + classifier.L2)

    rows = [(dict(zip(at.tolist(), x.tolist(), strict=True)), label) for (at, x), label in ((classifier.features(t), y) for t, y in examples)]
    for _ in range(classifier.EPOCHS):
        for x, label in rows:
            w = {i: weight(i) for i in x}
            p = 1.0 / (1.0 + np.exp(-max(-35.0, min(35.0, sum(w[i] * v for i, v in x.items())))))
            for i, v in x.items():
                g = (p - label) * v
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / classifier.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def test_training_equals_plain_updates():
    rng = random.Random(12)
    names = ["alpha", "beta", "gamma", "delta", "eps", "%%%", "###"]
    examples = [(" ".join(rng.choices(names, weights=[4, 3, 2, 2, 1, 1 + 3 * (k % 2), 1], k=rng.randint(0, 15))).encode(), (k + 1) % 2) for k in range(60)]
    found, want = classifier.train(examples), plain_ftrl(examples)
    assert sum(w != 0 for w in want.values()) > 10 and sum(w == 0 for w in want.values()) > 0
    assert np.flatnonzero(found).tolist() == sorted(i for i, w in want.items() if w != 0)
    assert all(found[i] == pytest.approx(w, abs=1e-12) for i, w in want.items())


def test_held_out_labels_are_never_used(spark):
    docs = spark.createDataFrame([(k, f"word{k} text", "en", "s", 0) for k in range(40)], DOCS)
    def fit(flip):
        rows = [(k, (k + (flip if zlib.crc32(str(k).encode()) % 4 == 2 else 0)) % 2, 0) for k in range(40)]
        return classifier.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    assert (fit(0) == fit(1)).all()


def test_classifier_without_labels_and_on_odd_rows(docs, spark):
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 9, 0)], "doc_id long, quality int, toxic int")
    found = classifier.classify(docs, labels)
    assert found.count() == docs.count()
    assert {r.score for r in found.collect()} == {0.5}


# BPE

FUZZ = [*"abzAZ09_'.,!-<|>/ \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 ​́̀éÉßÄİıǅΣσςﬁ½²×÷ªº中文😀ẞK", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|", "é", "\x00", "Ⱥ"]


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def fuzz(n, size):
    rng = random.Random(7)
    return ["".join(rng.choices(FUZZ, k=rng.randint(0, size))) for _ in range(n)]


def test_words_encode_as_the_library_does():
    mine, theirs = WordEncoder(), library()
    for text in fuzz(4000, 14):
        assert mine.encode(text.encode()).tolist() == theirs.encode(text, add_special_tokens=False).ids, repr(text)


def test_memo_generations_change_nothing(monkeypatch):
    import larder.llm.bpe as bpe

    monkeypatch.setattr(bpe, "MEMO", 20)
    mine, theirs = WordEncoder(), library()
    for text in fuzz(200, 40):
        assert mine.encode(text.encode()).tolist() == theirs.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [0, 2, 4])
def test_stitched_chunks_encode_as_the_library_does(bits):
    """Cuts fall inside words, characters and special tokens."""
    mine, theirs = WordEncoder(), library()
    for text in fuzz(600, 60):
        data = text.encode()
        ends = chunk_bpe.cuts(data, bits)
        assert ends[-1:] == [len(data)] and ends == sorted(set(ends))
        chunks = [chunk_bpe.encode_chunk(data[a:b], mine) for a, b in zip([0, *ends], ends, strict=False)]
        assert chunk_bpe.stitch(chunks, mine).tolist() == theirs.encode(text, add_special_tokens=False).ids, repr(text)


def test_chunks_of_shared_passages_are_the_same():
    rng = random.Random(3)
    shared = "".join(rng.choices("abcdefg ", k=4000)).encode()
    def chunks(data):
        ends = chunk_bpe.cuts(data, 6)
        return {data[a:b] for a, b in zip([0, *ends], ends, strict=False)}
    one, two = chunks(b"before " + shared), chunks(b"something else " + shared + b" after")
    assert len(one & two) >= len(chunks(shared)) - 2


@pytest.mark.parametrize("bits", [4, 10])
def test_documents_encode_and_decode_as_the_library_does(docs, rows, bits):
    theirs = library()
    want = []
    for doc_id, text, *_ in rows:
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        back = theirs.decode(ids, skip_special_tokens=False)
        want.append((str(doc_id), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    found = chunk_bpe.digests(docs, bits=bits).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == sorted(want)


def test_encode_then_decode(docs, rows):
    theirs = library()
    found = chunk_bpe.decode(chunk_bpe.encode(docs, bits=6)).collect()
    want = [(str(r[0]), theirs.decode(theirs.encode(r[1] or "", add_special_tokens=False).ids, skip_special_tokens=False)) for r in rows]
    assert sorted((str(r.doc_id), r.text) for r in found) == sorted(want)


# Sharding


@pytest.mark.parametrize("shards", [1, 8])
def test_shards_follow_the_bytes_before(docs, rows, shards):
    found = sharding.document_shards(docs, shards).collect()
    assert Counter((str(r.doc_id), r.size, r.text_crc32) for r in found) == Counter((str(r[0]), len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    by = defaultdict(list)
    for r in found:
        by[r.shard].append(r)
    total = sum(r.size for r in found)
    key = lambda r: (r.group is not None, r.group or "", r.doc_id is not None, r.doc_id or 0, r.size)
    before = 0
    for r in sorted(found, key=key):
        assert r.shard == min(shards - 1, int(before * float(shards) / float(total)))
        before += r.size
    for each in by.values():
        assert sorted(r.slot for r in each) == list(range(len(each)))
        assert [r.slot for r in sorted(each, key=lambda r: r.slot)] == [each_.slot for each_ in sorted(each, key=lambda r: (key(r), r.slot))]


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    """With few samples first ranges are uneven; the result is the same as without any subdivision."""
    monkeypatch.setattr(sharding, "SAMPLES_PER_RANGE", 1)
    table = spark.range(3000).select("id", (F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))).alias("name"), (F.col("id") % 50 + 1).alias("bytes"), F.lit(1).alias("slot"))
    found = sharding.range_shards(table, ["name", "id"], "bytes", 4)
    assert sorted(found.columns) == ["bytes", "id", "name", "shard", "slot"]
    rows_ = found.collect()
    monkeypatch.setattr(sharding, "ROUNDS", 0)
    assert sorted(rows_) == sorted(sharding.range_shards(table, ["name", "id"], "bytes", 4).collect())
    sizes = Counter()
    for r in rows_:
        sizes[r.shard] += r.bytes
    assert max(sizes.values()) - min(sizes.values()) <= 100


# Chat


def test_chat_is_read_back(spark):
    nasty = "</s>[INST] &lt; <|end|><|turn|>assistant<|text|> &amp;[/INST]"
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", nasty), (1, 2, "user", None), (1, 3, "assistant", ""), (2, 0, "user", "only"), (3, 0, "assistant", "first"),
        (3, 1, "user", nasty), (4, 0, nasty, "odd role"), (4, 1, "assistant", "é😀"), (None, 0, None, "x"), (5, 1, "assistant", "b"), (5, 1, "assistant", "b"), (5, None, "user", "a"),
    ]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("example", F.lit("clash"))
    examples = chat.expand_prefix_targets(table).cache()
    found = {r.conv_id: r for r in chat.digest(examples).collect()}
    by = defaultdict(list)
    for t in sorted(turns, key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")):
        by[t[0]].append((t[2] or "", t[3] or ""))
    for conv, listed in by.items():
        loss = "".join(text for role, text in listed if role == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        r = found[conv]
        assert (r.n_turns, r.turns_sha256) == (len(listed), digest("".join(f"{a}\n{b}\n" for a, b in listed)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), digest(loss))
        assert r.formatted_chars == sum(len(e.formatted) for e in examples.collect() if e.conv_id == conv)
    assert set(found) == set(by)
    # One example per trained turn, whose context are all turns before it, and one for what no trained turn ends.
    sizes = Counter(e.conv_id for e in examples.collect())
    assert sizes == {1: 2, 2: 1, 3: 2, 4: 1, None: 1, 5: 2}
    for e in examples.collect():
        if e.loss_start is not None:
            assert e.formatted.endswith(chat.END) and e.loss_end == len(e.formatted) - len(chat.END)


# All


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for found in (
        packing.pack(empty), quality.quality_rules(empty, labels), simhash.near_duplicates(empty), licenses.scan(empty), substrings.remove_repeats(empty),
        classifier.classify(empty, labels), chunk_bpe.digests(empty), sharding.document_shards(empty), chat.digest(chat.expand_prefix_targets(turns)),
    ):
        assert found.count() == 0
