"""The training-data operators against brute force, round trips and hard cases."""

import base64
import collections
import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from clinflow.llm import bpe, contamination, exact_dedup, licenses, near_dedup, pii, quality, secrets, sharding, warc
from clinflow.llm.shingles import Shingler

SF = "/root/testdata/sf0.001"
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words long, text_sha256 string, h long, rid long"
LONG = "Überlänge naïve words " * 4000
HARD = [(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""), (5, LONG), (6, LONG), (7, "x"), (7, "x"), (None, "a b c d e f"), (8, "\n \t"), (9, "漢字 and 𝒳 mail a@b.co +1 (555) 123-4567"), (9, None)]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(i, t, None, None, None, 1, "x", 2, 3) for i, t in HARD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_golomb_round_trip():
    r = np.random.default_rng(1)
    for n in (1, 2, 50, 4000):
        v = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
        assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(v)) == v).all()


def test_exact_duplicates(hard, empty):
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(hard).collect()]
    assert collections.Counter(got) == collections.Counter(
        [(1, 2, 3, False), (2, 2, 3, True), (None, 2, 3, False), (3, 9, 3, False), (4, 9, 3, False), (9, 9, 3, True), (5, 6, 2, False), (6, 6, 2, True), (7, 7, 2, True), (7, 7, 2, False), (8, 8, 1, True), (9, 9, 1, True)]
    )
    assert exact_dedup.exact_duplicates(empty).count() == 0
    kept = exact_dedup.drop_copies(hard)
    assert kept.columns == hard.columns and sorted(r.doc_id for r in kept.collect()) == [2, 6, 7, 8, 9, 9]


def test_sharding(hard, empty, documents):
    for docs in (hard, documents):
        rows = sharding.shards(docs).collect()
        slots = collections.defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
        sizes = [len(slots[s]) for s in range(16)]
        assert len(rows) == docs.count() and max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(16))
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in documents.select("doc_id", "text").collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == want
    assert sharding.shards(empty).count() == 0


def test_sharding_keeps_groups_together(spark):
    docs = spark.createDataFrame([(i, f"t{i // 4}") for i in range(640)], "doc_id long, text string")
    shard = {r.doc_id: r.shard for r in sharding.shards(docs).collect()}
    whole = sum(len({shard[4 * g + k] for k in range(4)}) == 1 for g in range(160))
    assert whole >= 120


def test_sharding_splits_a_hot_group(spark):
    docs = spark.createDataFrame([(i, "same" if i % 2 else f"t{i}") for i in range(400)], "doc_id long, text string")
    sizes = collections.Counter(r.shard for r in sharding.shards(docs).collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_warc(spark, tmp_path):
    body = "é漢" * 30_000
    pages = spark.createDataFrame([(1, "http://a b", body, 0), (2, "u", body, 0), (3, None, None, 0), (4, "u", "", 0), (5, "u", "a\r\n\r\nWARC/1.1\r\n\r\nb", 0), (None, "u", body, 0), (6, "u", "x", 0), (6, "u", "x", 0)], "page_id long, url string, html string, body int")
    warc.write_archives(pages, f"file://{tmp_path}/w")
    rows = warc.page_records(spark, f"file://{tmp_path}/w").collect()
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    got = collections.Counter(tuple(r) for r in rows)
    n = len(body.encode())
    odd = "a\r\n\r\nWARC/1.1\r\n\r\nb"
    assert got == collections.Counter([(1, n, sha(body), "response", None), (2, n, sha(body), "revisit", 1), (None, n, sha(body), "revisit", 1), (3, 0, sha(""), "response", None), (4, 0, sha(""), "revisit", 3), (5, len(odd), sha(odd), "response", None), (6, 1, sha("x"), "response", None), (6, 1, sha("x"), "revisit", 6)])
    assert warc.read_archives(spark, f"file://{tmp_path}/w").filter("segment > 1").count() > 2
    nulls = spark.createDataFrame([(None, "u", "same"), (None, "v", "same"), (-1, "w", "minus"), (4, "w", "minus")], "page_id long, url string, html string")
    warc.write_archives(nulls, f"file://{tmp_path}/n")
    got = collections.Counter((r.page_id, r.record_type, r.refers_to) for r in warc.page_records(spark, f"file://{tmp_path}/n").collect())
    assert got == collections.Counter([(None, "response", None), (None, "revisit", None), (-1, "response", None), (4, "revisit", -1)])
    warc.write_archives(pages, f"file://{tmp_path}/v", min_revisit_bytes=10)
    assert {(r.page_id, r.record_type) for r in warc.page_records(spark, f"file://{tmp_path}/v").collect() if r.page_id in (3, 4, 6)} == {(3, "response"), (4, "response"), (6, "response")}


def test_warc_files_of_many_members(spark, tmp_path):
    """Archives of other writers: one gzip member for each record or for all; blocks that look like records; none at all."""
    blocks = [b"x" * n for n in (0, 1, 70_000, 5)] + [b"\xff\x00\x80", b"a\r\n\r\nWARC/1.1\r\n\r\nb", b"\r\n\r\nWARC/1.", b"\r\n\r\n", b"WARC/1.0"]
    records = [b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x-page:%d:>\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (k, len(b), b) for k, b in enumerate(blocks)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    (tmp_path / "a" / "many.warc.gz").write_bytes(b"".join(map(gzip.compress, records)) * 30)
    (tmp_path / "a" / "none.warc.gz").write_bytes(gzip.compress(b""))
    r = random.Random(3)  # ends and beginnings of records at every place of a reader's buffer
    odd = [b"".join(r.choices([b"\r\n", b"\r\n\r\n", b"W", b"WARC/", b"WARC/1.", b"x" * r.randint(1, 4000)], k=r.randint(0, 9))) for _ in range(3000)]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "odd.warc.gz").write_bytes(gzip.compress(b"".join(b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x-page:%d:>\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (k, len(b), b) for k, b in enumerate(odd)), 1))
    assert {r.page_id: bytes(r.block) for r in warc.read_archives(spark, f"file://{tmp_path}/b").collect()} == dict(enumerate(odd))
    got = collections.Counter((r.page_id, bytes(r.block)) for r in warc.read_archives(spark, f"file://{tmp_path}/a").collect())
    assert got == {(k, b): 31 for k, b in enumerate(blocks)}
    for bad in (records[1][:-3], records[2][:100], b"x" + records[1], records[3] + b"tail", records[1].replace(b"Length: 1", b"Length: 0")):
        with pytest.raises(ValueError):
            list(warc.parse_records(iter(bad.split(warc.BEGIN))))


def test_warc_archive_beyond_a_batch(spark, tmp_path):
    """An archive of 200 MB is read a record at a time: no row or batch holds more than a part of it."""
    record = lambda k: b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x-page:%d:>\r\nContent-Length: 100000\r\n\r\n%b\r\n\r\n" % (k, bytes([97 + k % 26]) * 100_000)
    with open(tmp_path / "large.warc.gz", "wb") as out:
        for k in range(2000):
            out.write(gzip.compress(record(k), 1))
    rows = warc.read_archives(spark, f"file://{tmp_path}").select("page_id", F.length("block").alias("n"), F.substring(F.col("block").cast("string"), 1, 1).alias("c"))
    found = rows.collect()
    assert len(found) == 2000 and all(r.n == 100_000 and r.c == chr(97 + r.page_id % 26) for r in found)


def test_warc_framing():
    for body in (b"", b"x", "é".encode() * 10_000):
        assert warc.dechunked(warc.chunked(body, 7)) == body
    assert warc.dechunked(b"3;a=b\r\nabc\r\n0\r\nT: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.dechunked(b"3\r\nabcX\r\n0\r\n\r\n")


@pytest.fixture(scope="module")
def models():
    ranks = bpe.load_ranks(RANKS)
    return bpe.PrefixBpe(ranks, PATTERN), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_is_as_the_library(models, documents, hard):
    mine, other = models
    random.seed(3)
    texts = [r.text for r in documents.limit(60).collect()] + [t or "" for _, t in HARD]
    texts += ["".join(random.choice(["a", "aa", "th", " ", "  ", "1", "é", "'s", "!!", "\n", "漢", "\x1c", "\x85", "²"]) for _ in range(random.randint(1, 40))) for _ in range(300)]
    for t in [*texts, "a" * 3000, "=" * 500]:
        assert mine.encode(t) == other.encode_ordinary(t)
        assert mine.decode(mine.encode(t)) == t.encode()


def test_bpe_appends_and_edits(models):
    mine, _ = models
    old, new = b"international", b"internationally"
    assert mine.extend(new, mine.extend(old, [])) == mine.extend(new, [])
    assert mine.edited(new, mine.extend(new, []), b"interval") == mine.extend(b"interval", [])


def test_bpe_queries(hard, empty, models):
    rows = bpe.token_digests(hard, RANKS, PATTERN).collect()
    want = collections.Counter((i, hashlib.sha256(" ".join(map(str, models[1].encode_ordinary(t or ""))).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in HARD)
    assert collections.Counter((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    assert bpe.token_digests(empty, RANKS, PATTERN).count() == 0
    back = bpe.decoded(bpe.encoded(hard, RANKS, PATTERN), RANKS, PATTERN).filter("decoded <> coalesce(text, '')")
    assert back.count() == 0


def test_trigram_queries():
    assert secrets.trigram_query("abcd") == ("and", "abc", "bcd")
    assert secrets.trigram_query("[0-9a-f]+") is True
    assert secrets.trigram_query("(?:foo|bar)x*") == ("or", "bar", "foo")
    assert set(secrets._leaves(secrets.trigram_query(secrets.BASE[0].pattern))) >= {"pas", "tok", "key"}


def test_secrets(spark, empty, documents):
    cases = ['x PassWord : "abcdefgh" y', "apikey=short", "AKIA" + "A" * 12, "AKIA" + "A" * 11, "f" * 31, "g" + "f" * 32, "é api_key='0123456789abcdef0123456789abcdef'", "ghp_" + "z" * 36, "token=ſecret", None, "-----BEGIN RSA PRIVATE KEY-----", "paſsword=abcdefgh12 to\u212aen=abcdefgh12"]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(cases)], "doc_id long, text string, spans int")
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.spans) for r in secrets.secret_spans(df).collect()}
    assert got[0] == (1, 0, 0, "assign:2:22") and got[1][0] == 0 and got[2][1] == 1 and got[3][1] == 0 and got[4][2] == 0
    assert got[5] == (0, 0, 1, "hex:1:33") and got[6] == (1, 0, 1, "assign:2:43,hex:11:43") and got[7][3] == "github:0:40" and got[9] == (0, 0, 0, "") and got[10][3].startswith("private_key:0")
    assert got[11] == (0, 0, 0, "")  # only ASCII letters, in either case
    everything = tuple(secrets.Rule(r.kind, r.pattern, r.least, r.group) for r in secrets.RULES)
    for r in secrets.secret_spans(documents, everything).join(documents.select("doc_id", "text"), "doc_id").collect():
        brute = sorted((a, k, b) for k, x in enumerate(everything) for a, b in secrets.spans_of(r.text, x, re.compile(x.pattern).finditer))
        assert r.spans == ",".join(f"{everything[k].kind}:{a}:{b}" for a, k, b in brute)
    assert secrets.secret_spans(empty).count() == 0
    assert "abcdefgh" not in secrets.redacted(df).filter("doc_id = 0").first().text


def test_near_duplicates(spark, hard, empty):
    random.seed(5)
    base = [" ".join(random.choice("abcdefghij") + str(random.randint(0, 30)) for _ in range(60)) for _ in range(12)]
    texts = []
    for b in base:
        for _ in range(12):
            w = b.split(" ")
            for _ in range(random.randint(0, 6)):
                w[random.randrange(len(w))] = "new" + str(random.randint(0, 99))
            texts.append(" ".join(w))
    for width in (2, 5):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, width=width).collect()}
        sets = [set(zip(*(t.split()[k:] for k in range(width)))) for t in texts]
        parent = list(range(len(texts)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for i in range(len(texts)):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    a, b = root(i), root(j)
                    parent[max(a, b)] = min(a, b)
        assert got == {i: root(i) for i in range(len(texts))}
    rows = collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(hard).collect())
    assert rows[1, 5, 1, True] == 1 and rows[2, 5, 1, False] == 1 and rows[None, 5, 1, False] == 1
    assert rows[3, 0, 3, True] == 1 and rows[8, 0, 8, True] == 1 and rows[6, 3, 5, False] == 1 and rows[7, 1, 7, True] == 2
    assert near_dedup.near_duplicates(empty).count() == 0


def test_shingles_of_long_texts_are_whole():
    text = ("w%d " * 1) % 1 + " ".join(f"w{i}" for i in range(150_000))
    (one,) = Shingler(2).sets([text])
    two, _ = Shingler(2).sets([text, "x"])
    assert (one == two).all() and len(one) == 149_999 + 1
    a, b, c = Shingler(2).sets(["A b", "a\tB", "a"])
    assert (a == b).all() and len(c) == 1


def test_contamination(spark, hard, empty):
    item = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(1, item), (2, "Short one"), (3, None), (4, "!!"), (None, "x y"), (10, item)], "item_id long, text string")
    texts = [item.upper() + " tail", "a " * 400 + "SHORT, one", "short two one", " ".join(f"w{i}" for i in range(12)), " ".join(f"w{i}" for i in range(5, 18)), None]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, w int")
    want = {}
    windows = {tuple(f"w{i}" for i in range(k, k + 13)): ("1", "10") for k in range(8)} | {("short", "one"): ("2",)}
    for i, t in enumerate(texts):
        ws = re.findall(contamination.WORD.replace(r"\x2F", "/").replace(r"\x3A-\x60", ":-`"), (t or "").lower())
        hit, ids = set(), set()
        for w, own in windows.items():
            for k in range(len(ws) - len(w) + 1):
                if tuple(ws[k : k + len(w)]) == w:
                    hit |= set(range(k, k + len(w)))
                    ids |= set(own)
        want[i] = (len(ws), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(ws))
    for grams in (contamination.GRAMS, 0):  # with and without the first look
        kept, contamination.GRAMS = contamination.GRAMS, grams
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in contamination.contamination(df, items).collect()}
        contamination.GRAMS = kept
        assert got == want
    assert contamination.contamination(hard, items).count() == len(HARD) and contamination.contamination(empty, items).count() == 0
    assert contamination.contamination(df, items.limit(0)).filter("n_hit > 0").count() == 0
    left = contamination.drop_contaminated(df, items)
    assert left.columns == df.columns and {r.doc_id for r in left.collect()} == {i for i, w in want.items() if not w[4]}


def test_quality_held_out(spark, hard, empty):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train, held = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    found = quality.quality(docs, train).join(held, "doc_id").select("keep", "quality").collect()
    assert sum(r.keep == (r.quality == 1) for r in found) >= 0.97 * len(found)
    assert quality.quality(hard, labels.limit(0)).filter("keep").count() == len(HARD)
    assert quality.quality(empty, labels).count() == 0
    # the posteriors again, by plain sums over the other documents of a site and path
    at = {r.doc_id: (r.source, r.lang) for r in docs.collect()}
    rows = quality.quality(docs, train).collect()
    _, all_ = quality.posteriors(spark.createDataFrame([(*at[r.doc_id], r.p_document) for r in rows], "site string, path string, p double"))
    odds = lambda p: np.log(p / (1 - p))
    of_site, of_path = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        of_site[at[r.doc_id][0]].append(r)
        of_path[at[r.doc_id]].append(r)
    for r in rows[::7]:
        mean = np.mean([x.p_document for x in rows if x.doc_id != r.doc_id])
        site = [x.p_document for x in of_site[at[r.doc_id][0]] if x.doc_id != r.doc_id]
        path = [x.p_document for x in of_path[at[r.doc_id]] if x.doc_id != r.doc_id]
        p_site = (sum(site) + all_["site"] * mean) / (len(site) + all_["site"])
        p_path = (sum(path) + all_["path"] * p_site) / (len(path) + all_["path"])
        p = min(max(r.p_document, 1e-6), 1 - 1e-6)
        want = 1 / (1 + np.exp(-(odds(p) + odds(p_path) - odds(mean))))
        assert abs(r.p_path - p_path) < 1e-9 and abs(r.p_quality - want) < 1e-6 and r.keep == (r.p_quality >= quality.THRESHOLD)
    good = quality.keep_good(docs, train)
    assert sorted(x.doc_id for x in good.select("doc_id").collect()) == sorted(r.doc_id for r in rows if r.keep)
    assert good.columns == docs.columns and 0 < good.count() < docs.count()


def local_alignment(text, template):
    """Best local alignment without a band: (score, matched words)."""
    best, above = (0, 0), [(0, 0)] * (len(text) + 1)
    for word in template:
        row = [(0, 0)]
        for i, x in enumerate(text):
            same = x == word
            d, u, v = above[i], above[i + 1], row[i]
            cell = max(((d[0] + (2 if same else -1)), d[1] + same), (u[0] - 1, u[1]), (v[0] - 1, v[1]))
            row.append(cell if cell[0] > 0 else (0, 0))
            best = max(best, row[-1])
        above = row
    return best


def test_alignment_in_the_band_is_the_best_one():
    r = random.Random(4)
    for _ in range(60):
        template = [r.randint(1, 40) for _ in range(30)]
        copy = [x if r.random() > 0.1 else 99 for x in template]
        for _ in range(r.randint(0, 3)):
            copy.insert(r.randrange(len(copy)), 77)
        for _ in range(r.randint(0, 3)):
            copy.pop(r.randrange(len(copy)))
        head = [r.randint(50, 60) for _ in range(r.randint(0, 20))]
        text = head + copy + [r.randint(50, 60) for _ in range(10)]
        assert licenses.align(text, template, len(head))[:2] == local_alignment(text, template)


def test_alignments_side_by_side_are_those_made_alone():
    r = random.Random(4)
    jobs = []
    for _ in range(400):
        k, n = r.choice([2, 3, 8, 50]), r.choice([0, 1, r.randint(0, 60), r.randint(100, 300)])
        template, text = [r.randrange(1, k + 1) for _ in range(n)], [r.randrange(1, k + 1) for _ in range(r.randint(0, 10))]
        for w in template:
            u = r.random()
            text += [] if u < 0.1 else [r.randrange(1, k + 1) for _ in range(r.randint(1, 5))] + [w] if u < 0.25 else [w]
        jobs.append((np.array(text, np.uint64), np.array(template, np.uint64), r.randint(-6, 12), {r.randrange(n): 1 << q for q in range(3)} if n else {}))
    want = [licenses.align(x.tolist(), y.tolist(), d, licenses.BAND, m) for x, y, d, m in jobs]
    assert licenses.align_all(jobs) == want and licenses.align_all(jobs[:3]) == want[:3] and licenses.align_all([]) == []


def test_licenses(spark, hard, empty, documents):
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.LEAST)
    names = lambda text: [x[2] for x in scanner.scan(text.encode())]
    for name, text in licenses.TEMPLATES.items():  # every template is found in itself, whole
        assert any(x[2] == name and x[3] == x[4] for x in scanner.scan(("é x " + text + " y").encode()))
    text = "Foo.\nReleased under the MIT Licence! License.\n" + licenses.TEMPLATES["mit-text"].replace("free of charge", "for free, of any charge") + " é Licensed under CC BY-NC 4.0."
    found = {x[2]: x for x in scanner.scan(text.encode())}
    assert {"mit-text", "cc-by-nc-4.0"} <= set(found)
    a, b, *_ = found["cc-by-nc-4.0"]
    assert text[a:b] == "Licensed under CC BY-NC 4.0"
    # versions and variants
    assert names("Licensed under CC BY 4.0") == ["cc-by-4.0"] and names("licensed under cc by-sa 4.0") == ["cc-by-sa-4.0"]
    assert names("licensed under the GNU General Public License, version 2") == ["gpl-2.0"] and names("This work is licensed under the GNU Lesser General Public License, version 3") == ["lgpl-3.0"]
    assert names("Licensed under the Apache License, Version 1.1") == [] and names("This work is licensed under the GNU General Public License, version 4") == []
    # words put in near the middle
    words = licenses.TEMPLATES["mit-text"].split()
    ((a, b, name, m, n),) = scanner.scan(" ".join([*words[:80], *(f"new{i}" for i in range(30)), *words[80:]]).encode())
    assert name == "mit-text" and m == n and a == 0
    # a text together with others has the same spans as alone
    texts = [t.encode() for t in ("", "x", text, licenses.TEMPLATES["gpl-3.0"], "permission is", "hereby granted free", licenses.TEMPLATES["apache-2.0-text"])]
    assert list(scanner.scan_all(texts)) == [scanner.scan(t) for t in texts]
    assert scanner.scan(b"") == [] and licenses.license_spans(empty).count() == 0 and licenses.license_spans(hard).count() == len(HARD)
    # against alignments without fingerprints or band, for one-line statements
    lines = {k: [x.lower() for x in re.findall("[A-Za-z0-9]+", licenses.TEMPLATES[k])] for k in ("mit", "apache-2.0", "gpl-3.0", "cc-by-nc-4.0")}
    for r in licenses.license_spans(documents).join(documents.select("doc_id", "text"), "doc_id").collect():
        assert (r.n_licenses > 0) == bool(re.search(r"Licensed under|MIT License|is licensed under", r.text))
        if len(r.text) < 4000:
            ws = [x.lower() for x in re.findall("[A-Za-z0-9]+", r.text)]
            assert {x.split(":")[0] for x in r.licenses.split(",") if x} == {k for k, t in lines.items() if local_alignment(ws, t)[1] == len(t)}


def test_winnowing_guarantee():
    r = random.Random(1)
    for _ in range(200):
        shared = [r.randint(1, 9) for _ in range(licenses.K + licenses.W - 1)]
        a = np.array([r.randint(1, 9) for _ in range(10)] + shared + [r.randint(1, 9) for _ in range(10)], np.uint64)
        b = np.array([r.randint(1, 9) for _ in range(5)] + shared, np.uint64)
        ha, hb = licenses.hashes_of(a), licenses.hashes_of(b)
        assert set(ha[licenses.winnow(ha)].tolist()) & set(hb[licenses.winnow(hb)].tolist())


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, SF)
        rows = out.cache().count()
        assert 0 < rows <= docs.count()
        if k < len(p.STAGES) - 1:
            assert out.columns == docs.columns and out.select("doc_id").distinct().count() == rows
        docs = out
    assert docs.filter("n_tokens > 0").count() > 0


def test_pipeline_near_copies_with_null_and_repeated_ids(spark):
    import corpus_pipeline as p

    r = random.Random(11)
    fresh = lambda: [f"w{r.randint(0, 10**9)}" for _ in range(80)]
    groups = [[" ".join([*base, *(f"end{k}" for k in range(j))]) for j in range(4)] for base in (fresh(), fresh(), fresh(), fresh())]
    rows = [(1, groups[0][0]), (None, groups[0][1])]  # a null id that is not the smallest
    rows += [(None, groups[1][0]), (None, groups[1][1])]  # null ids alone
    rows += [(2, groups[2][0]), (2, groups[2][1]), (None, groups[2][2])]  # the smallest id repeats
    rows += [(3, groups[3][0]), (7, groups[3][1]), (3, groups[3][0])]  # the text that stays repeats
    clean = [(None, " ".join(fresh())), (None, " ".join(fresh())), (7, " ".join(fresh())), (2, " ".join(fresh())), (None, None), (None, " "), (8, " ")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows + clean)], "doc_id long, text string, n long")

    def sets(text):
        w = text.split()
        return {tuple(w[k : k + p.NEAR_WORDS]) for k in range(len(w) - p.NEAR_WORDS + 1)}

    want = list(clean)
    left = list(rows)
    while left:  # each group is a clique
        near = [x for x in left if 100 * len(sets(x[1]) & sets(left[0][1])) >= 80 * len(sets(x[1]) | sets(left[0][1]))]
        left = [x for x in left if x not in near]
        want.append(min(near, key=lambda x: (x[0] is None, x[0] or 0, hashlib.sha256(x[1].encode()).hexdigest())))
    out = p.without_near_copies(spark, docs, SF)
    assert out.columns == docs.columns
    assert collections.Counter((x.doc_id, x.text) for x in out.collect()) == collections.Counter(want)


def test_contamination_by_items_with_a_null_id(spark):
    import duckdb

    from clinflow.llm.queries import ORACLES

    item = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(None, item), (None, "Short one"), (3, "short one"), (4, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a " + item), (2, "a short one"), (3, "else"), (None, item), (5, " ".join(["a"] * 900) + " " + item)], "doc_id long, text string")
    got = contamination.contamination(docs.filter("doc_id is not null"), items)
    con = duckdb.connect()
    for name, df in (("documents", docs.filter("doc_id is not null")), ("benchmark", items)):
        con.register(name, df.toArrow())
    want = con.sql(ORACLES["op1_decontamination"])
    assert sorted(got.select(*want.columns).toArrow().to_pylist(), key=str) == sorted((dict(zip(want.columns, x, strict=True)) for x in want.fetchall()), key=str)
    found = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in contamination.contamination(docs, items).collect()}
    assert found == {1: (20, 0, True), 2: (2, 1, True), 3: (0, 0, False), None: (20, 0, True), 5: (20, 0, False)}
    assert sorted(r.doc_id for r in contamination.drop_contaminated(docs, items).collect()) == [3, 5]
