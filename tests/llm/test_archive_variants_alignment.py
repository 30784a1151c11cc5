"""Archive, spelling variants and tokenizer alignment against brute-force versions, and on odd rows."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from larder.llm import alignment, variants, warc
from larder.llm.bpe import vocabulary_path
from tests.llm.test_operators import CLASHES, DOCS, FUZZ, corpus

MORE_CLASHES = [*CLASHES, "digest", "payload", "record_id", "copy", "part", "doc", "a", "b", "plane", "links", "word", "form", "root", "side", "start", "best", "near", "low", "high", "first", "value"]


# Archive


def page_rows():
    text = "<html>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n</html>\r\n\r\n"
    bodies = [None, "", "x", "x", text, text, "é中😀", "\r\n\r\n", "\r\n\r\n\r\n\r\n", "<p>" * 40_000, "x", None, "\n"]
    rows = [(k, f"http://e.example/{k}", h) for k, h in enumerate(bodies)]
    rows += [(20, "http://e.example/20", "twice"), (20, "http://e.example/20", "twice"), (20, "http://e.example/other", "twice"), (21, None, "no url"), (22, "http://e.example/a\r\nb", "odd url")]
    rows += [(None, "http://e.example/none", "x"), (None, None, "only unnamed"), (None, None, "only unnamed"), (-5, "http://e.example/-5", "x")]
    return rows + [(100 + k, "http://e.example/hot", "hot page") for k in range(300)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(page_rows(), "page_id long, url string, html string").repartition(3).withColumns({c: F.lit("clash") for c in MORE_CLASHES}).cache()


def digest_of(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("least", [0, 2])
def test_archive_is_read_back(spark, pages, tmp_path, least):
    rows = page_rows()
    low = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    groups = defaultdict(list)
    for r in rows:
        groups[r[2] or ""].append(r)
    want = Counter()
    for html, members in groups.items():
        small = len(html.encode()) < least
        first, *others = sorted(members, key=low, reverse=True)
        for r in [first] + (others if small else []):
            want[r[0], len(html.encode()), digest_of(html), "response", None] += 1
        for r in [] if small else others:
            want[r[0], len(html.encode()), digest_of(html), "revisit", first[0]] += 1
    found = warc.written_and_read(pages, f"{tmp_path}/files", min_bytes=least)
    assert found.schema["page_id"].dataType.simpleString() == found.schema["refers_to"].dataType.simpleString() == "bigint"
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect()) == want


def test_payloads_are_stored_once_and_captures_are_whole(spark, pages, tmp_path):
    stored = warc.archive(pages)
    bodies = [(r[2] or "").encode() for r in page_rows()]
    assert sorted(bytes(r.payload) for r in warc.verified(stored.payloads).collect()) == sorted(set(bodies))
    found = warc.captures(stored).collect()
    assert Counter((r.page_id, bytes(r.payload)) for r in found) == Counter((r[0], (r[2] or "").encode()) for r in page_rows())
    # The files hold the same records, byte for byte, and each header tells the length of its block.
    warc.write_files(stored, f"{tmp_path}/files", records_per_file=7)
    back = {r.record_id: r for r in warc.resolved(warc.read_files(spark, f"{tmp_path}/files")).collect()}
    assert len(back) == len(found)
    for r in found:
        got = back[r.record_id]
        assert (got.header, got.http, got.payload) == (r.header, r.http, r.payload)
        fields = dict(line.split(b": ", 1) for line in bytes(r.header).split(b"\r\n")[1:-2])
        assert int(fields[b"Content-Length"]) == len(r.http) + (len(r.payload) if r.record_type == "response" else 0)
        assert fields[b"WARC-Payload-Digest"].decode() == "sha1:" + digest_of(bytes(r.payload).decode())
        if r.record_type == "revisit":
            assert back[fields[b"WARC-Refers-To"].decode().strip("<>")].record_type == "response"


def test_same_input_gives_the_same_records(pages):
    names = lambda a: sorted(bytes(r.header) for r in a.records.collect())
    assert names(warc.archive(pages)) == names(warc.archive(pages.repartition(7)))


def test_damaged_archives_are_errors(spark, pages, tmp_path):
    stored = warc.archive(pages)
    x = F.col("digest") == hashlib.sha256(b"x").digest()
    broken = warc.Archive(stored.records, stored.payloads.withColumn("packed", F.when(x, F.lit(zstandard.compress(b"y"))).otherwise(F.col("packed"))))
    with pytest.raises(Exception, match="does not have its digest"):
        warc.captures(broken).collect()
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.parse(iter([b"WARC/1.1\r\nContent-Length: 9", b"short"])))
    with pytest.raises(ValueError, match="does not start"):
        list(warc.parse(iter([b"HTTP/1.1 200 OK"])))


def test_empty_archive(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.written_and_read(none, f"{tmp_path}/files").count() == 0


# Spelling variants


def slow_words(rows, rate=31):
    seen = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % rate == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def slow_variants(count):
    near = defaultdict(list)
    for a, b in combinations(count, 2):
        if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, n in count.items():
        best = min(near[w], key=lambda x: (-count[x], x), default=None)
        form[w] = best if best is not None and count[best] >= 10 * n else None
    out = []
    for w, n in count.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), count[form[w]] if form[w] else None))
    return sorted(out, key=lambda r: r[0])


def variant_rows():
    rng = random.Random(4)
    letters = "abcdeéßÀ"
    base = ["".join(rng.choices(letters, k=rng.randint(7, 10))) for _ in range(40)]
    texts = []
    for k, w in enumerate(base):
        edits = [w[:j] + rng.choice(letters) + w[j + rng.randint(0, 1) :] for j in rng.sample(range(len(w)), 5)]
        texts.append(" ".join([w] * (30 + 7 * k) + [e for e in edits for _ in range(rng.randint(1, 4))]))
    chain = ["aaaaaaaa"] * 300 + ["aaaaaaab"] * 30 + ["aaaaaabb"] * 3
    texts += [" ".join(chain), "MiXeDcase9mixedcase mixedcase×mixedcase÷x ĀbcdefghijĀ", "aaaaaaa " * 2, "x" * 3000 + " " + "x" * 3000 + " " + "x" * 2999 + " " + "x" * 2999, None, "", "short"]
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)]
    return rows + [rows[3], (None, "without without withaut withaut aname", "en", "s", 0)]


def plain(found):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("tile", [8, 40_000])
def test_variants_equal_brute_force(spark, tile):
    rows = variant_rows() + corpus()
    docs = spark.createDataFrame(rows, DOCS).repartition(3).withColumns({c: F.lit("clash") for c in MORE_CLASHES})
    want = slow_variants(slow_words(rows))
    assert plain(variants.variants(docs, tile=tile)) == want
    assert sum(r[1] is not None for r in want) > 20 and any(r[2] != r[1] for r in want if r[1])


def test_composition_finds_every_pair_once():
    rng = random.Random(9)
    for size, letters in ((60, "ab"), (200, "abc"), (300, "abcdefgh")):
        words = sorted({"".join(rng.choices(letters, k=rng.randint(0, 7))) for _ in range(size)})
        found = [(words[x], words[y]) for x, y in variants.Composition(variants.Acceptor(words)).pairs().tolist()]
        assert len(found) == len(set(found))
        assert {frozenset(p) for p in found} == {frozenset(p) for p in combinations(words, 2) if one_edit(*p)}


def test_acceptor_is_minimal():
    words = sorted(a + b for a in ("read", "talk", "walk") for b in ("", "ed", "ing", "s"))
    made = variants.Acceptor(words)
    languages = []
    for q in range(len(made.out)):
        stack, found = [(q, "")], set()
        while stack:
            state, word = stack.pop()
            if made.final[state]:
                found.add(word)
            stack += [(target, word + symbol) for symbol, (target, _) in made.out[state].items()]
        languages.append(frozenset(found))
    assert len(set(languages)) == len(languages)
    assert languages[made.start] == set(words) and made.count[made.start] == len(words)


@pytest.mark.parametrize("least", [1, 2, 3, 4])
def test_short_words_too(spark, least):
    rng = random.Random(least)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(least, 5))) for _ in range(80)})
    table = spark.createDataFrame([(w, 1 + k % 5) for k, w in enumerate(words)], "word string, n long")
    found = {r.word: r.n_near for r in variants.near_words(table, least).collect()}
    want = Counter(w for p in combinations(words, 2) if one_edit(*p) for w in p)
    assert found == dict(want)


def test_no_words(spark):
    assert variants.variants(spark.createDataFrame([], DOCS)).count() == 0


# Alignment


def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))


def slow_tokens(text, a, b):
    """(id, start, end) of both sides; none where the bytes differ."""
    if not text:
        return [], []
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    back = {chr(x): x for x in visible} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in visible)}
    sides = []
    for ids, data in (
        (ids := a.encode(" " + text, add_special_tokens=False).ids, [bytes(back[c] for c in a.id_to_token(k)) for k in ids]),
        (ids := b.encode(text), [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids)]),
    ):
        if b"".join(data) != (" " + text).encode():
            return [], []
        ends = np.cumsum([len(x) for x in data]).tolist()
        sides.append([(k, e - len(x), e) for k, x, e in zip(ids, data, ends, strict=True)])
    return tuple(sides)


def slow_alignment(texts):
    a, b = libraries()
    rows, count = [], Counter()
    for text in texts:
        x, y = slow_tokens(text, a, b)
        links = [(p[0], q[0]) for p in x for q in y if p[1] < q[2] and q[1] < p[2]]
        common = sorted({p[2] for p in x} & {q[2] for q in y})
        groups, before = [], 0
        for end in common:
            inside = lambda side, low=before, high=end: ",".join(str(p[0]) for p in side if low < p[2] <= high)
            groups.append(f"{inside(x)}|{inside(y)}")
            before = end
        count.update(links)
        rows.append((len(x), len(y), groups, links))
    most = defaultdict(int)
    for (_, q), n in count.items():
        most[q] = max(most[q], n)
    return [
        (na, nb, len(g), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for na, nb, g, links in rows
    ], count


def aligned_texts():
    rng = random.Random(6)
    odd = ["".join(rng.choices(FUZZ + ["▁", " ", "  ", "\n\n", "<0x41>", "<s>", "<unk>"], k=rng.randint(1, 25))) for _ in range(150)]
    spaced = [" lead", "trail ", "  two  spaces  ", " ", "\t", "a\n b", "don't  stop's", "naïve café", "▁under", "1234567 89", "word " * 500]
    return odd + spaced + [r[1] and r[1][:1500] for r in corpus()]


@pytest.mark.parametrize("links", [50, 3_000_000])
def test_alignment_equals_brute_force(spark, monkeypatch, links):
    """Also with many small parts, and with repeated rows and rows without a name."""
    monkeypatch.setattr(alignment, "PART_LINKS", links)
    texts = aligned_texts()
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)]
    rows += [rows[-1], rows[-1], (None, "no name", "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3).withColumns({c: F.lit("clash") for c in MORE_CLASHES})
    want, _ = slow_alignment([r[1] for r in rows])
    found = alignment.align(docs)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = [(str(r.doc_id), *(r[n] for n in names)) for r in found.collect()]
    assert sorted(got) == sorted((str(r[0]), *w) for r, w in zip(rows, want, strict=True))
    for r in found.collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")
    assert sum(w[0] == 0 for w in want) >= 5


def test_pair_counts_and_document_counts(spark):
    texts = ["the cat sat", "the the the", "a cat", None, "the cat"] * 40
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], DOCS).repartition(2)
    _, count = slow_alignment(texts)
    a, b = libraries()
    documents = Counter()
    for t in texts:
        x, y = slow_tokens(t, a, b)
        documents.update({(p[0], q[0]) for p in x for q in y if p[1] < q[2] and q[1] < p[2]})
    found = alignment.pair_counts(alignment.indexed(docs)).collect()
    assert {(r.a, r.b): (r.documents, r.links) for r in found} == {p: (documents[p], n) for p, n in count.items()}


def test_memo_changes_nothing(monkeypatch):
    texts = [t or "" for t in aligned_texts()]
    make = lambda: alignment.Aligner(vocabulary_path(alignment.BYTE_VOCABULARY), vocabulary_path(alignment.PIECE_VOCABULARY))
    want = make().align(texts)
    monkeypatch.setattr(alignment, "MEMO", 10)
    small = make()
    assert [small.align([t])[0] for t in texts] == want
    whole = make()
    whole.apart = False
    assert whole.align(texts) == want


def test_no_texts(spark):
    assert alignment.align(spark.createDataFrame([], DOCS)).count() == 0
