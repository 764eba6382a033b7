"""The operators on tables with nulls, empty texts, ties, repeated rows, clashing columns and no rows; oracles."""

import hashlib
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import bpe, cws, language, mixing, quality, queries, simhash, topk, toxicity, urlfilter, warc
from millrace.llm.next_document import with_edited
from millrace.session import scratch_path
from tests.conftest import SF

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, fp string, place string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
TEXT = " ".join(WORDS[i * 7 % 20] + str(i) for i in range(60))
ROWS = [
    (1, TEXT, "en", "b", 1, "x", "y", "z"),
    (2, TEXT, "en", "b", 1, "x", "y", "z"),
    (2, TEXT, "en", "b", 1, "x", "y", "z"),
    (3, None, None, None, None, None, None, None),
    (4, "", "de", "a", 0, None, None, None),
    (None, "lone text without an id", None, "a", 3, None, None, None),
    (7, "word " * 30_000, "de", "é", 0, None, None, None),
    (8, "12 !?", None, None, 0, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_simhash_groups(docs):
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_dedup(docs).collect()}
    assert simhash.near_dedup(docs).count() == len(ROWS)
    assert {got[k] for k in got if k[0] in (1, 2)} == {1}
    assert got[(3, "0" * 16)] == got[(4, "0" * 16)] == 3
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in simhash.keep_one(docs).collect())
    assert kept == [(False, 1), (False, 3), (False, 7), (False, 8), (True, 0)]
    assert simhash.near_dedup(docs.limit(0)).count() == simhash.keep_one(docs.limit(0)).count() == 0


def test_simhash_links_equal_all_pairs_with_small_chunks(spark):
    base = [hash((i, 5)) & ((1 << 64) - 1) for i in range(5)]
    fps = sorted({b ^ (1 << i) ^ (1 << (i * 7 % 64)) for b in base for i in range(30)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, chunk=8)
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    root = {f: f for f in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(signed):
        for b in signed[:i]:
            if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {f: got.get(f, f) for f in signed} == {f: find(f) for f in signed}


def test_texts_are_scored_and_encoded(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (4, 0, 1), (7, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for table in (docs, docs.limit(0)):
        n = table.count()
        for op in (quality, toxicity):
            got = op.score(table, op.fit(table, labels, F.lit(True))).collect()
            assert len(got) == n and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
            assert op.score(table, op.fit(table, labels.limit(0), F.lit(True))).count() == n
        got = {r.doc_id: r.lang_pred for r in language.predict(table, language.fit(table, F.lit(True))).collect()}
        assert not n or got[3] == got[4] == got[8] == "und"
        ids = bpe.encode(table, queries.public_tokenizers.path(queries.RANKS), queries.public_tokenizers.PATTERN)
        back = bpe.decode(ids, queries.public_tokenizers.path(queries.RANKS), queries.public_tokenizers.PATTERN)
        assert sorted(r.text for r in back.collect()) == sorted(r.text or "" for r in table.collect())


def test_mix(docs):
    rows = mixing.mix(docs, block=16).collect()
    assert len(rows) == len(ROWS) and all(r.taken <= 2 * r["size"] for r in rows)
    assert {r.source: r.target for r in rows}.keys() == {None, "a", "b", "é"}
    total = sum(r["size"] for r in rows)
    # weights 3, 1, 2, 3 by code point with null last, full sources reshared
    goal, size = {r.source: r.target for r in rows}, {r.source: r.source_size for r in rows}
    assert math.isclose(sum(goal.values()), 1.5 * total) and all(goal[s] <= 2 * size[s] + 1e-9 for s in goal)
    for s in goal:
        assert abs(sum(r.taken for r in rows if r.source == s) - goal[s]) <= 32
    words = mixing.mixed_documents(docs, block=16).agg(F.sum(mixing.word_count("text"))).first()[0]
    assert words == sum(r.taken for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs, block=16).collect()))
    assert mixing.mix(docs.limit(0)).count() == mixing.mixed_documents(docs.limit(0)).count() == 0


def test_permutation(spark):
    for n in (1, 2, 7, 100):
        got = spark.range(n).select(mixing._permuted(F.col("id"), F.lit(n), [F.lit(3)]).alias("x")).collect()
        assert sorted(r.x for r in got) == list(range(n))


def test_edited_texts(spark, docs):
    rows = [(5, "abcdéf"), (3, "xy"), (9, "123456789"), (1, None), (3, "xyz")]
    got = {(r.key, r.text): r.edited for r in with_edited(spark.createDataFrame(rows, "doc_id long, text string"))[0].collect()}
    assert got == {(9, "123456789"): "123456abc", (5, "abcdéf"): "abcdxy", (3, "xy"): "xy", (3, "xyz"): "xy", (1, ""): ""}
    assert with_edited(docs)[0].count() == len(ROWS)


def test_collision_rate_is_generalised_jaccard(spark):
    a, b = {i: 1 + i % 5 for i in range(40)}, {i: 1 + i % 3 for i in range(15, 60)}
    rows = [("a", k, w) for k, w in a.items()] + [("b", k, w) for k, w in b.items()]
    terms = spark.createDataFrame(rows, "key string, term long, weight long")
    places = 256
    f = {r.key: r.fingerprint for r in cws.signatures(terms, ["key"], places).collect()}
    same = sum(f["a"][4 * i : 4 * i + 4] == f["b"][4 * i : 4 * i + 4] for i in range(places)) / places
    union = a.keys() | b.keys()
    truth = sum(min(a.get(k, 0), b.get(k, 0)) for k in union) / sum(max(a.get(k, 0), b.get(k, 0)) for k in union)
    assert abs(same - truth) < 0.12
    blank = cws.fingerprint_texts(spark.createDataFrame([(1, None), (2, " \n")], "key int, text string"), ["key"])
    assert {r.fingerprint for r in blank.collect()} == {cws.BLANK * cws.PLACES}


def test_url_rules(spark):
    pages = spark.createDataFrame([(1, "http://WWW.Example.COM/en/x?y"), (2, "https://a.net/es"), (3, "b.net/es/"), (4, None), (4, None), (5, "x://a.net/fr/#q"), (6, "http://example.com/en/1://z"), (7, "http://xexample.com/en/")], "page_id long, url string")
    rules = urlfilter.rules_table(spark, queries.URL_RULES)
    got = sorted(map(tuple, urlfilter.judge(pages, rules).collect()))
    assert got == [
        (1, "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        (2, "a.net", "/es", None, "allow"),
        (3, "", "", None, "allow"),
        (4, "", "", None, "allow"),
        (4, "", "", None, "allow"),
        (5, "a.net", "/fr/", "net/fr/", "block"),
        (6, "example.com", "/en/1://z", "example.com/en/", "block"),
        (7, "xexample.com", "/en/", "com/", "allow"),
    ]
    assert urlfilter.judge(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urlfilter.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_warc(spark):
    big = "é" * 600
    rows = [(1, "u", big), (2, None, big), (2, "u", big), (None, "u", big), (3, "u", "s"), (4, "u", "s"), (5, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    index = warc.write(pages, scratch_path(spark, "warc-test"))
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read(index).collect())
    assert got == [(0, 1200, "revisit", 2), (1, 1200, "revisit", 2), (2, 1200, "response", None), (2, 1200, "response", None), (3, 1, "response", None), (4, 1, "response", None), (5, 0, "response", None)]
    one = warc.read(index.where("page_id = 3")).first()
    assert one.payload == b"s" and one.payload_digest == hashlib.sha1(b"s").hexdigest()
    assert warc.read(warc.write(pages.limit(0), scratch_path(spark, "warc-test"))).count() == 0


def test_topk_edges(spark):
    rows = spark.createDataFrame([(0, [1, 2]), (20, [1, 2]), (1, [1, 2]), (1, [1, 2]), (2, []), (3, None), (4, [None, 1]), (None, [1, 1]), (40, [3])], "vec_id long, vector array<long>")
    got = sorted(map(tuple, topk.search(rows.where("vec_id % 20 = 0"), rows, k=2).collect()))
    assert got == [(0, 1, 1, 5), (0, 2, 20, 5), (20, 1, 0, 5), (20, 2, 1, 5)]
    assert topk.search(rows.limit(0), rows).count() == topk.search(rows, rows.limit(0)).count() == 0


def test_topk_over_cells_equals_sorting(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(topk, "SAMPLE", 60)
    rng = np.random.default_rng(5)
    far = rng.integers(-300, 300, (6, 4))
    x = np.r_[far[rng.integers(0, 6, 500)] + rng.integers(-9, 9, (500, 4)), np.repeat(far[:1], 300, 0)]
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, [i, 2 * i]) for i in range(25)] + [(7, x[7].tolist())] * 40
    rows = spark.createDataFrame(data, "vec_id long, vector array<long>").withColumn("cell", F.lit("own")).withColumn("floor", F.lit("own"))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(rows.where("vec_id % 20 = 0"), rows, k=20, block=100, group=10).collect())
    want, plain = [], dict(data)
    for q in (i for i in plain if i % 20 == 0):
        near = sorted((-int(np.dot(plain[q], v)), i) for i, v in plain.items() if i != q and len(v) == len(plain[q]))[:20]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near)]
    assert got == sorted(want)
    sample = topk._sample(rows.select("vec_id", "vector"), 865)
    some = topk._dealt(rows.select("vec_id", "vector").where("vec_id % 20 = 0").distinct(), sample, 4, 20)
    every = topk._dealt(rows.select("vec_id", "vector").distinct(), sample, 9)
    pairs = topk.cell_pairs(some, every, sample, 100, 10)
    assert 0 < len(pairs) < some.select("cell").distinct().count() * every.select("cell").distinct().count()


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_return_every_row(spark, name):
    df = queries.QUERIES[name](spark, SF)
    rows = df.collect()
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    if name in queries.ORACLES:
        rel = con.sql(queries.ORACLES[name])
        want = [tuple(r) for r in rel.select(*df.columns).fetchall()]
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    else:
        assert sorted(r.doc_id for r in rows) == sorted(x for (x,) in con.sql("SELECT doc_id FROM documents").fetchall())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    for name, label in (("op1_quality", "quality"), ("op4_toxicity", "toxic")):
        r = queries.QUERIES[name](spark, sf).where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]
        assert r > 0.93, name
    r = queries.op9_language(spark, sf).where("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert r > 0.97


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, kept, SF).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns and kept.count() > 0
        assert not kept.select("doc_id").exceptAll(before.select("doc_id")).count() or name == "source_mix"
        if name == "simhash_near_dedup":
            own = simhash.near_dedup(before)
            assert kept.count() == own.select("component_id").distinct().count()
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert last.count() == kept.count() and "ids" in last.columns


def test_stages_keep_columns_of_the_caller(spark):
    """Columns named like those that the operators make."""
    own = ["score", "predicted", "lang_pred", "_row", "_n", "_words", "_pass", "_own", "_text", "fp", "place", "_c0"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*[F.concat(F.lit(f"{c}/"), F.col("doc_id").cast("string")).alias(c) for c in own], "*")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns, name
        assert kept.dtypes == docs.dtypes, name
        rows = kept.collect()
        assert rows and all(r[c] == f"{c}/{r.doc_id}" for r in rows for c in own), name


def test_numbers_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog"), (2, "\u00b2"), (3, "\u00bd \u00be"), (4, "\u2167"), (5, "a\u00b2")], "doc_id long, text string")
    model = language.fit_model(["the cat and the dog " * 5, "der hund und die katze " * 5], ["en", "de"], rounds=5)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, model).collect()}
    assert got[2] == got[3] == got[4] == ("und", 0.0) and got[1][0] == "en" and got[5][0] != "und"


def test_warc_headers_are_as_others_read_them(spark):
    """A plain reader of the format: gzip members, header lines, unique ids, urls as they were."""
    import gzip
    import re
    from pathlib import Path

    folder = scratch_path(spark, "warc-plain")
    big = "x" * 1200
    rows = [(1, "http://a.org/%20x?q=%25", big), (2, "http://a.org/b\nc", big), (2, "http://a.org/b\nc", big), (None, "http://a.org/\u00e9", "s"), (None, None, "s")]
    index = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    seen = []
    for file in Path(folder.removeprefix("file:")).glob("*.warc.gz"):
        raw = gzip.decompress(file.read_bytes())
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            fields = dict(re.findall(r"^([^:\r\n]+): (.*?)\r?$", head.decode(), re.M))
            n = int(fields["Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[n : n + 4] == b"\r\n\r\n"
            seen.append(fields)
            raw = rest[n + 4 :]
    assert len(seen) == len({f["WARC-Record-ID"] for f in seen}) == 5
    assert sorted(f.get("WARC-Target-URI", "") for f in seen) == ["", "http://a.org/%20x?q=%25", "http://a.org/b%0Ac", "http://a.org/b%0Ac", "http://a.org/\u00e9"]
    assert [f["WARC-Refers-To-Target-URI"] for f in seen if f["WARC-Type"] == "revisit"] == ["http://a.org/b%0Ac"]
    assert sorted(str(r.url) for r in warc.read(index).collect()) == sorted(str(r[1]) for r in rows)


def test_topk_products_beyond_a_long(spark):
    big = 1 << 62
    rows = spark.createDataFrame([(0, [big, big]), (1, [big, big]), (2, [-big, -big]), (3, [1, 0]), (4, [-big, -big])], "vec_id long, vector array<long>")
    got = [tuple(r)[1:] for r in sorted(topk.search(rows.where("vec_id = 0"), rows, k=4).collect())]
    assert got == [(1, 1, (1 << 63) - 1), (2, 3, big), (3, 2, 2 - (1 << 63)), (4, 4, 2 - (1 << 63))]
