"""Hand-worked edge cases."""

from pyspark.sql import functions as F

from millrace.functions import arrays as A
from millrace.functions import porter
from millrace.functions import records as RC
from millrace.functions import text as T
from millrace.functions import urls as U
from millrace.operators import blocks as B
from millrace.operators import frontier as FR
from millrace.operators import prompting as PR
from millrace.operators import rank as R
from millrace.operators import records as REC


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_pieces_are_lossless(spark):
    texts = ["", " a", "a  b\n\nc ", "x\ty\n", "éà ß!  "]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(F.array_join(T.pieces("v"), "")).collect()]
    assert got == texts


def test_stop_words_keep_punctuated(spark):
    assert one(spark, T.preprocess(F.col("v")), "The, law of  the Land") == ["the", "law", "land"]


def test_chunk_counts_reference_mode(spark):
    size, overlap = 10, 3
    df = spark.createDataFrame([(n,) for n in [0, overlap - 1, overlap, size, size + 1]], "n int")
    got = [r[0] for r in df.select(A.chunk_count(F.col("n"), size, overlap, "reference")).collect()]
    assert got == [0, 0, 1, 2, 2]  # n = size gives a chunk of pure overlap (Q6)


def test_chunks_whole_mode_keeps_short_text(spark):
    df = spark.createDataFrame([("a b",)], "v string").select(T.pieces("v").alias("p"))
    assert df.select(F.size(A.chunks("p", 10, 3))).first()[0] == 1


def test_valid_utf8_drops_broken_bytes_only(spark):
    df = spark.createDataFrame([(bytearray(b"a\xef\xbf\xbdb"),), (bytearray(b"a\xffb\xef\xbf\xbd\x01bc"),), (None,)], "v binary")
    got = [r[0] for r in df.select(T.valid_utf8(F.col("v").cast("string"))).collect()]
    assert got == ["a\ufffdb", "ab\ufffd\x01bc", None]


def _walk(spark, seeds, edges):
    s = spark.createDataFrame(seeds, "source string, url string, max_depth int")
    e = spark.createDataFrame(edges, "src string, dst string, kind string")
    rows = FR.expand(s, e, ["banned.com"]).collect()
    assert len(rows) == len({(r["source"], r["url"], r["kind"]) for r in rows})
    return {(r["source"], r["url"].removeprefix("http://a.com/"), r["depth"]) for r in rows}


def _edges(*pairs):
    return [(f"http://a.com/{a}", f"http://a.com/{b}", "file" if b.endswith(".pdf") else "page") for a, b in pairs]


def test_frontier_cycle_and_file_at_last_depth(spark):
    edges = _edges(("s", "x"), ("x", "s"), ("x", "y"), ("x", "f.pdf"), ("y", "g.pdf"))
    assert _walk(spark, [("a", "http://a.com/s", 1), ("a", "http://a.com/s", None)], edges) == {("a", "s", 0), ("a", "x", 1), ("a", "f.pdf", 2)}


def test_frontier_each_seed_has_its_own_depth(spark):
    edges = _edges(("s", "x"), ("x", "y"), ("y", "z"), ("t", "u"), ("u", "v"), ("u", "x"))
    seeds = [("a", "http://a.com/s", 1), ("a", "http://a.com/t", 3)]
    # x is found at depth 1 with nothing left and again at depth 2 with one step left
    assert _walk(spark, seeds, edges) == {("a", "s", 0), ("a", "t", 0), ("a", "x", 1), ("a", "u", 1), ("a", "v", 2), ("a", "y", 3)}


def test_frontier_has_no_level_cap(spark):
    edges = _edges(*[(f"p{i}", f"p{i + 1}") for i in range(6)])
    assert len(_walk(spark, [("a", "http://a.com/p0", 5)], edges)) == 6


def _gated(spark, seeds, edges, scores, **options):
    s = spark.createDataFrame(seeds, "source string, url string, max_depth int")
    e = spark.createDataFrame(edges, "src string, dst string, kind string")
    table = spark.createDataFrame([(f"http://a.com/{u}", x) for u, x in scores.items()], "url string, score double")
    asked = []

    def scorer(urls):
        asked.extend(r.url.removeprefix("http://a.com/") for r in urls.collect())
        return table.join(urls, "url", "left_semi")

    rows = FR.expand(s, e, ["banned.com"], scorer=scorer, gate=0.0, **options).collect()
    assert len(asked) == len(set(asked))  # no page is scored twice
    return {(r["source"], r["url"].removeprefix("http://a.com/"), r["depth"]) for r in rows}, set(asked)


def test_gated_page_hides_its_children(spark):
    edges = _edges(("s", "good"), ("s", "bad"), ("bad", "hidden"), ("bad", "h.pdf"), ("good", "x"), ("good", "f.pdf"), ("x", "bad"), ("x", "gone"))
    scores = {"s": 0.4, "good": 0.1, "bad": -0.2, "hidden": 0.9, "x": 0.3}  # no page is stored for "gone"
    kept, asked = _gated(spark, [("a", "http://a.com/s", 5)], edges, scores)
    assert kept == {("a", "s", 0), ("a", "good", 1), ("a", "x", 2), ("a", "f.pdf", 2)}
    assert asked == {"s", "good", "bad", "x", "gone"}
    followed, _ = _gated(spark, [("a", "http://a.com/s", 5)], edges, scores, follow_gated=True)
    assert followed == kept | {("a", "hidden", 2), ("a", "h.pdf", 2)}
    assert _gated(spark, [("a", "http://a.com/bad", 3)], edges, scores)[0] == set()
    assert _gated(spark, [], edges, scores)[0] == set()


def test_sources_share_one_set_of_visits(spark):
    edges = _edges(("s", "x"), ("t", "u"), ("u", "x"), ("x", "y"), ("y", "s"))
    scores = dict.fromkeys("stuxy", 1.0)
    seeds = [("b", "http://a.com/s", 3), ("a", "http://a.com/t", 3)]
    kept, _ = _gated(spark, seeds, edges, scores, shared=True)
    assert kept == {("b", "s", 0), ("a", "t", 0), ("b", "x", 1), ("a", "u", 1), ("b", "y", 2)}


def test_frontier_goes_again_where_more_steps_are_left(spark):
    edges = _edges(("s", "x"), ("x", "y"), ("y", "z"), ("t", "u"), ("u", "x"))
    scores = dict.fromkeys("stuxyz", 1.0)
    kept, _ = _gated(spark, [("a", "http://a.com/s", 1), ("a", "http://a.com/t", 4)], edges, scores)
    assert kept == {("a", "s", 0), ("a", "t", 0), ("a", "x", 1), ("a", "u", 1), ("a", "y", 3), ("a", "z", 4)}


def test_ban_table(spark):
    from millrace.operators.bans import banned_hosts, drop_banned

    links = ["https://www.microsoft.com/", "https://t.co/x", "http://u@A.t.co:80/", "https://xt.co", "mailto:a@t.co", "http://b.c.d.org./", "//d.org", None]
    df = spark.createDataFrame([(x,) for x in links], "link string")
    bans = spark.createDataFrame([("t.co",), ("d.org",), ("C.d.org.",), ("",), (None,)], "domain string")
    assert {r.link for r in drop_banned(df, bans).collect()} == {links[0], links[3], links[4], links[6], None}
    assert {r.host: r.ban for r in banned_hosts(df, bans).collect()} == {"t.co": "t.co", "u@A.t.co:80": "t.co", "b.c.d.org.": "c.d.org"}
    assert drop_banned(df, bans.limit(0)).count() == len(links)


def test_parse_pairs(spark):
    lines = ["1. ABC - Alpha Beta", "2. U.S. - United States", "U.S. - no index", "x - y - z", "no dash", "", None]
    df = spark.createDataFrame([(l,) for l in lines], "v string")
    got = [r[0] for r in df.select(RC.parse_pair(F.col("v"))).collect()]
    assert got[0].asDict() == {"term": "ABC", "expansion": "Alpha Beta"}
    assert got[1].asDict() == {"term": "U.S.", "expansion": "United States"}
    assert got[2].asDict() == {"term": "S.", "expansion": "no index"}
    assert got[3].asDict() == {"term": "x", "expansion": "y - z"}
    assert got[4] is None and got[5] is None and got[6] is None


def test_last_wins_across_rows(spark):
    rows = [(1, "A - first\nB - one"), (2, "A - second"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, generated_text string")
    got = {r["input"]: r["output"] for r in REC.pair_records(df, "x {}").collect()}
    assert got == {"A": "second", "B": "one"}


def test_first_wins_only_for_marked_kind(spark):
    rows = [("Expand the following: {}", "A", "a1", "f1", 0), ("Expand the following: {}", "A", "a2", "f2", 0),
            ("Other {}", "A", "o1", "f1", 0), ("Other {}", "A", "o1", "f2", 1)]
    df = spark.createDataFrame(rows, "instruction string, input string, output string, file string, pos int")
    got = sorted(tuple(r) for r in REC.consolidate(df, "Expand the following", ["file", "pos"]).collect())
    assert got == [("Expand the following: {}", "A", "a1"), ("Other {}", "A", "o1"), ("Other {}", "A", "o1")]


def test_sentence_min_length(spark):
    s49, s50 = "a" * 48 + ".", "b" * 49 + "."
    assert one(spark, A.long_sentences(F.col("v")), f"{s49} {s50}") == [s50]


def test_packing_exact_fit(spark):
    # lengths 60 + 68 = 128 fit exactly; the next sentence opens a new block
    df = spark.createDataFrame([([60, 68, 10],)], "l array<int>")
    got = [tuple(b) for b in df.select(A.pack_blocks(F.col("l"), 128)).first()[0]]
    assert got == [(0, 1, 128), (2, 2, 10)]


def test_blocks_have_fixed_length(spark):
    text = " ".join(["This sentence is long enough to be kept in a block for sure."] * 30)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = B.pack_documents(df).collect()
    assert rows and all(len(r["input_ids"]) == 128 for r in rows)
    assert [r["block_no"] for r in rows] == list(range(len(rows)))


def test_exact_split_is_disjoint_and_complete(spark):
    df = spark.range(0, 1001).withColumnRenamed("id", "k")
    out = B.exact_split(df, F.col("k"), 42, 0.95, "floor")
    c = dict(out.groupBy("split").count().collect())
    assert c == {"train": 950, "validation": 51}
    assert out.select("k").distinct().count() == 1001


def test_cut_by_counting_equals_sorting(spark, monkeypatch):
    from millrace.operators import select as SEL

    monkeypatch.setattr(SEL, "FEW", 3)
    n = 701
    scores = [None if i % 97 == 0 else float("-inf") if i % 91 == 0 else (i * 7919 % 50) / 7 - 3 for i in range(n)]
    df = spark.createDataFrame([(i * 3 - 400, s) for i, s in enumerate(scores)], "k long, s double")
    order = sorted(((float("-inf") if s is None else s), i * 3 - 400) for i, s in enumerate(scores))
    for f in (0.0, 0.001, 0.8, 0.5, 1.0):
        got = sorted(r.k for r in SEL.keep_top(df, "s", "k", f).collect())
        k = int(n * f)
        assert got == sorted(x for _, x in order[n - k:])
    assert SEL.keep_top(df.limit(0), "s", "k").count() == 0
    for f, r, k in ((0.95, "floor", 665), (0.5, "half_even", 350), (0.0, "floor", 0), (1.0, "floor", n)):
        out = {x.k: x.split for x in B.exact_split(df.select("k"), F.col("k"), 1, f, r).collect()}
        import hashlib

        ranked = sorted(out, key=lambda x: (hashlib.md5(f"1/{x}".encode()).hexdigest(), str(x)))
        assert [out[x] for x in ranked] == ["train"] * k + ["validation"] * (n - k)
    plan = B.exact_split(df, F.col("k"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert B.exact_split(df.limit(0), F.col("k")).count() == 0


def test_stage_counts_come_with_the_result(spark):
    from millrace.plans.corpus_filter import filter_corpus

    rows = [(i, f"u{i}", "s", "word " * i) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, url string, source string, content string")
    metrics = {}
    kept = filter_corpus(docs, "word", "other", min_tokens=20, metrics=metrics).collect()
    assert {k: m.get["n"] for k, m in metrics.items()} == {"loaded": 40, "token_filter": 20, "relevance_filter": len(kept)}


def test_distributed_rank_matches_sort(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 500).alias("k"), F.col("id"))
    ranked = R.with_rank(df, [F.col("k").desc(), "id"], "r").orderBy("r").collect()
    assert [r["r"] for r in ranked] == list(range(1, 501))
    assert [r["k"] for r in ranked] == sorted((r["k"] for r in ranked), reverse=True)


def test_urls(spark):
    base = "https://a.example.com/x/y.html?q=1#f"
    cases = {
        "https://b.org/p": "https://b.org/p",
        "//cdn.net/z": "https://cdn.net/z",
        "/abs": "https://a.example.com/abs",
        "rel": "https://a.example.com/x/rel",
        "#frag": "https://a.example.com/x/y.html?q=1#frag",
        "mailto:me@x.com": "mailto:me@x.com",
    }
    df = spark.createDataFrame([(base, h) for h in cases], "b string, h string")
    got = {r[0]: r[1] for r in df.select("h", U.resolve("b", "h")).collect()}
    assert got == cases
    d = spark.createDataFrame([("http://localhost/x",), ("mailto:a@b.com",), ("https://www.microsoft.com/",)], "u string")
    doms = [r[0] for r in d.select(U.root_domain("u")).collect()]
    assert doms == [None, None, "microsoft.com"]
    banned = [r[0] for r in d.select(U.is_banned(U.root_domain("u"), ["t.co"], "contains")).collect()]
    assert banned == [False, False, True]  # 't.co' bans 'microsoft.com' by substring (Q7)
    kinds = spark.createDataFrame([("a.pdf",), ("a.PDF",), ("a.docx",)], "u string").select(U.link_kind("u")).collect()
    assert [k[0] for k in kinds] == ["file", "page", "file"]


def test_porter_words():
    expect = {"caresses": "caress", "ponies": "poni", "agreed": "agre", "hopping": "hop", "filing": "file",
              "relational": "relat", "generalizations": "gener", "laws,": "laws,", "sky": "sky"}
    assert {w: porter.stem(w) for w in expect} == expect


class FailingFactory:
    def __call__(self):
        return self

    def complete(self, prompt, system=None):
        if "boom" in prompt:
            raise RuntimeError("service down")
        return "ok", 2, 1


def test_prompt_failure_is_soft(spark):
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the test module
    df = spark.createDataFrame([("u1", "s", "fine"), ("u2", "s", "boom")], "url string, source string, content string")
    out = {r["url"]: r for r in PR.run_prompts(df, "{context}", "t", FailingFactory()).collect()}
    assert out["u1"]["generated_text"] == "ok" and out["u1"]["total_tokens"] == 3
    assert abs(out["u1"]["costs"] - (2 * 0.15e-6 + 1 * 0.6e-6)) < 1e-15
    assert out["u2"]["generated_text"] == "" and out["u2"]["total_tokens"] == 0 and out["u2"]["costs"] == 0.0


class CountingFactory:
    """Notes every call in a file; fails at some rows, or ends its worker while ``flag`` exists."""

    def __init__(self, calls, stop="", fails="", flag=""):
        self.calls, self.stop, self.fails, self.flag = calls, stop, fails, flag

    def __call__(self):
        return self

    def complete(self, prompt, system=None):
        import os

        if self.stop and self.stop in prompt and os.path.exists(self.flag):
            raise SystemExit("lost")
        with open(self.calls, "a") as f:
            f.write(prompt + "\n")
        if self.fails and self.fails in prompt and os.path.exists(self.flag):
            raise RuntimeError("service down")
        return "ok " + prompt, 2, 1


def _job(spark, tmp_path, **client):
    import sys

    from pyspark import cloudpickle

    from millrace.operators.batches import CommitLog

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    calls, flag = tmp_path / "calls", tmp_path / "flag"
    flag.touch()
    rows = spark.createDataFrame([(f"u{i:02}", "s", f"text {i:02}") for i in range(20)], "url string, source string, content string").coalesce(1)
    log = CommitLog(spark, str(tmp_path / "log"))
    run = lambda **o: log.run(rows, "t", "{context}", CountingFactory(str(calls), flag=str(flag), **client), ["url"], 4, **o)
    asked = lambda: calls.read_text().splitlines()
    return log, run, asked, flag


def test_lost_job_resumes_with_missing_calls(spark, tmp_path):
    import pytest
    from pyspark.errors import PySparkException

    log, run, asked, flag = _job(spark, tmp_path, stop="text 10")  # in batch 3 of 5
    with pytest.raises((PySparkException, Exception)):
        run()
    assert log.results().count() == 8 and [r.n_rows for r in log.manifest().orderBy("commit").collect()] == [4, 4]
    before = len(asked())
    flag.unlink()
    assert len(run()) == 3
    assert sorted(asked()[before:]) == [f"text {i:02}" for i in range(8, 20)]
    got = log.results().collect()
    assert sorted(r.generated_text for r in got) == [f"ok text {i:02}" for i in range(20)] and not any(r.error for r in got)
    assert run() == [] and log.results().count() == 20


def test_uncommitted_results_do_not_count(spark, tmp_path):
    log, run, asked, _ = _job(spark, tmp_path)
    run(batches_per_commit=5)
    half = log.attempts().limit(3).drop("commit")
    from millrace.sources import io as IO

    IO.write_csv(half, f"{log.folder}/results/commit=2")  # left by a run that was lost before its manifest entry
    assert log.results().count() == 20 and log.attempts().count() == 20 and len(asked()) == 20


def test_failed_rows_are_asked_again_on_demand(spark, tmp_path):
    log, run, asked, flag = _job(spark, tmp_path, fails="text 1")
    run(batches_per_commit=2)
    bad = [r for r in log.results().collect() if r.error]
    assert len(bad) == 10 and {r.error for r in bad} == {"RuntimeError: service down"} and {r.total_tokens for r in bad} == {0}
    flag.unlink()
    assert run() == [] and len(asked()) == 20
    run(retry_failed=True, batches_per_commit=2)
    assert len(asked()) == 30 and log.results().count() == 20 and log.results().where("error IS NOT NULL").count() == 0


def test_trim_marker(spark):
    from millrace.sources import io as IO

    df = spark.createDataFrame([(b"a\n%%EOF\njunk",), (b"a%%EOF\nb %%EOF x\njunk\n",), (b"none\n",)], "c binary")
    got = [r[0] for r in df.select(IO.trim_after_marker(F.col("c"))).collect()]
    assert got == [bytearray(b"a\n%%EOF\n"), bytearray(b"a%%EOF\nb %%EOF x\n"), bytearray(b"none\n")]


def test_instruction_without_placeholder_keeps_input(spark):
    df = spark.createDataFrame([("Do it.", "X"), ("Define {} now", "Y")], "i string, x string")
    got = [r[0] for r in df.select(RC.format_instruction(F.col("i"), F.col("x"))).collect()]
    assert got == ["Do it.\nX", "Define Y now"]


def test_links_are_anchors_only(spark):
    from millrace.functions import html as H

    page = """<link href="s.css"><!-- <a href="gone"> --><a href="x">1</a><A HREF='y'><a class=k href=z?a=1&amp;b=2><a name="n">"""
    row = spark.createDataFrame([(page,)], "html string").select(H.links("html").alias("l")).first()
    assert row.l == ["x", "y", "z?a=1&b=2"]


def test_white_space_of_any_kind(spark):
    from millrace.functions import text as T

    df = spark.createDataFrame([("\u00a0The\u3000cat\u2003The ",)], "t string")
    row = df.select(T.normalize("t").alias("n"), T.kept_words("t").alias("w")).first()
    assert row.n == "the\u3000cat\u2003the" and row.w == ["cat"]


def test_run_lengths(spark):
    from millrace.functions import arrays as A

    df = spark.createDataFrame([(["a", "a", "b"],), ([],)], "v array<string>").withColumn("e", A.run_ends(F.col("v")))
    rows = df.select(A.run_lengths(F.col("v"), F.col("e")).alias("r")).collect()
    assert [[tuple(x) for x in r.r] for r in rows] == [[("a", 2), ("b", 1)], []]


def test_dot_segments(spark):
    want = {
        "../z": "http://a.com/z",
        "./z": "http://a.com/x/z",
        "../../../z": "http://a.com/z",
        "..": "http://a.com/",
        "/p/./q/../r": "http://a.com/p/r",
        "z?p=/../q": "http://a.com/x/z?p=/../q",
        "a..b/c.": "http://a.com/x/a..b/c.",
    }
    df = spark.createDataFrame([(h,) for h in want], "h string")
    got = {r.h: r.u for r in df.select("h", U.resolve(F.lit("http://a.com/x/y"), "h").alias("u")).collect()}
    assert got == want


def _landed(spark, tmp_path):
    rows = [(1, "u1", "<body>kept</body>"), (2, "u2", "<body>out</body>"), (3, None, None), (3, None, None)]
    src = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    src.write.parquet(str(tmp_path / "in"))
    return [str(tmp_path / d) for d in ("in", "out", "ckpt")], rows


def test_append_keeps_whole_pages(spark, tmp_path):
    from millrace.streaming import pages as SP

    paths, rows = _landed(spark, tmp_path)
    SP.append_pages(spark, *paths)
    got = SP.read_sink(spark, paths[1]).select("page_id", "url", "html").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rows, key=repr)


def test_score_gate_keeps_whole_pages(spark, tmp_path):
    from millrace.streaming import pages as SP

    paths, rows = _landed(spark, tmp_path)
    scorer = lambda b: b.select("page_id", F.when(F.col("page_id") == 2, -1.0).otherwise(0.5).alias("score"))
    SP.score_gate_pages(spark, *paths, scorer)
    got = SP.read_sink(spark, paths[1]).select("page_id", "url", "html", "score").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(*r, 0.5) for r in rows if r[0] != 2], key=repr)


def test_window_dedup_forgets_old_keys(spark, tmp_path):
    import datetime

    from millrace.streaming import pages as SP

    t0 = datetime.datetime(2024, 1, 1)
    paths = [str(tmp_path / d) for d in ("in", "out", "ckpt")]
    at = lambda minutes: t0 + datetime.timedelta(minutes=minutes)
    for rows in ([(1, "a", at(0)), (2, "a", at(1)), (3, "b", at(2))], [(4, "a", at(3)), (5, "c", at(60))], [(6, "a", at(70)), (7, "c", at(61))], [(8, "x", at(5))]):
        spark.createDataFrame([(i, u, "h", t) for i, u, t in rows], "page_id bigint, url string, html string, fetched timestamp").coalesce(1).write.mode("append").parquet(paths[0])
        SP.dedup_window(spark, *paths, delay="10 minutes")
    # 'a' again after an hour counts as new; what comes an hour late is dropped
    assert sorted((r.url, r.page_id) for r in SP.read_sink(spark, paths[1]).collect() if r.url != "a") == [("b", 3), ("c", 5)]
    assert sorted(r.page_id for r in SP.read_sink(spark, paths[1]).where("url = 'a'").collect())[-1] == 6
    assert SP.read_sink(spark, paths[1]).where("url = 'a'").count() == 2


def test_new_checkpoint_keeps_the_sink(spark, tmp_path):
    from millrace.streaming import pages as SP

    paths, rows = _landed(spark, tmp_path)
    SP.append_pages(spark, *paths)
    SP.append_pages(spark, *paths[:2], str(tmp_path / "ckpt2"))
    assert SP.read_sink(spark, paths[1]).count() == 2 * len(rows)


def test_assembly_holds_every_turn(spark):
    from millrace.plans import q_io
    from millrace.session import table
    from tests.conftest import SF

    turns = table(spark, SF, "conversations").where("text IS NOT NULL")
    assert turns.select("role").distinct().count() > 1
    want = {f"conv/{r.conv_id}/{r.turn}" for r in turns.collect()}
    assert {r.url for r in q_io.assemble(spark, SF).where("source = 'conversations'").select("url").collect()} == want


def test_body_text_is_whole(spark):
    from millrace.functions import html as H

    pages = {
        "<head><title>T</title></head><body>a</body>b<p>c</body></html>": "a b c",
        "<head></head><p>x</p><body>a</body>b": "x a b",
        "<title>T</title><p>a<p>b": "a b",
        "<html><head><title>T</title></head><p>a</p></html>": "a",
        "<body class=x>a": "a",
        "plain": "plain",
        "<p>x</p></body>": "x",
        "": "",
    }
    df = spark.createDataFrame([(h,) for h in pages], "h string")
    assert {r.h: r.t for r in df.select("h", H.body_text("h").alias("t")).collect()} == pages


def _digested(spark, pages, fn, column):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    return [r[1] for r in sorted((r.page_id, r[column]) for r in fn(df).collect())]


def test_class_block_is_balanced(spark):
    from millrace.operators import elements as EL

    pages = {
        '<div>0</div><div class="ad">1<div>2<div>3</div></div> 4 </div><div class="ad">5</div>': "1234",
        '<div class="ad">1<div>2</div>3': "123",
        '<div><DIV id=x class="ad">1<divider>2</divider></DIV>3</div>': "12",
        "<div class='ad'>1</div>": "1",
        '<div class="big ad">1</div>2': "1",
        "<div class=ad>1 <!-- </div> --><script>'</div>'</script>2</div>3": "12",
        "</div></div><div title='<div class=ad>' class=bad>0</div><p class=ad>0<div data-x class = \"x\n ad\">&eacute;&#233;&#x41;&amp;lt;&unknown;&copy &#128;&#0;</div>": "éé" + "A&lt;&unknown;© €\ufffd",
        "<div>1</div>": None,
        '<div class="ad"></div>': None,
        "": None,
        None: None,
    }
    assert _digested(spark, pages, lambda df: EL.class_block(df, "ad"), "text") == list(pages.values())
    two = "<div class='a'>0</div><div class='b x a'>1</div>"
    assert _digested(spark, [two], lambda df: EL.class_block(df, "a b"), "text") == ["1"]


def test_section_digest_reads_all_sections(spark):
    from millrace.operators import elements as EL

    page = ('<article><h1>§ 1</h1><div id="a"><p>x</p></div></article><p id="no">n</p>'
            '<article><h1>2</h1><article><div id="b"><p>y</div></article><div id="c"></div></article><article><h1>§ 3</h1>')
    nested = "<article><h1>3</h1><div id=out><p id='in'>1&sect;</p><div ID=deep>0<p>2<br>3<p>4</div></div><i id=''></i><span id=last></span></article><p>5</p>"
    want = ["§ 1\na\nx\nb\ny\nc\n§ 3\n", "out\n1§\nin\ndeep\n23\nlast\n", "", ""]
    assert _digested(spark, [page, nested, "<p>none</p>", None], EL.section_digest, "digest") == want


def test_element_table(spark):
    from millrace.operators import elements as EL

    page = "<body><p>a<p>b<b>c</b></p></i><ul><li>1<li>2</ul><br></body>"
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    toks = EL.with_tokens(df)
    assert "".join(toks.first().tokens) == page
    got = {(r.tag, r.start): (r.end, r.nest, r.depth) for r in EL.element_table(toks).collect()}
    assert got == {
        ("body", 0): (17, 1, 1), ("p", 1): (3, 1, 2), ("p", 3): (8, 2, 2), ("b", 5): (7, 1, 3), ("ul", 10): (15, 1, 2),
        ("li", 11): (15, 1, 3), ("li", 13): (15, 2, 3), ("br", 16): (16, 1, 2),
    }


def test_split_blocks_hold_their_tokens(spark):
    from millrace.plans import q_blocks

    words = [f"word{i}" for i in range(200)]
    text = " ".join(words[:20]) + ". " + " ".join(words[20:60]) + ". short. " + " ".join(words) + "."
    docs = spark.createDataFrame([(1, text), (2, "nan"), (3, None), (4, "short.")], "doc_id long, text string")
    first = [["<s>", *words[:19], "word19.", "</s>"], ["<s>", *words[20:59], "word59.", "</s>"]]
    want = [sum(first, []), ["<s>", *words[:126], "</s>"]]
    want = [w + ["<pad>"] * (128 - len(w)) for w in want]
    for blocks in (B.pack_documents(docs), q_blocks.split_blocks(docs)):
        rows = blocks.orderBy("block_no").collect()
        assert [[t.strip() for t in r.input_ids] for r in rows] == want
        assert all(r.labels == r.input_ids for r in rows)


def test_registered_queries_build_the_tokens(spark):
    import __spark_entry__ as E
    from tests.conftest import SF

    for name in ("pck_block_tokens", "pip_pack_split_tokens"):
        rows = E.queries()[name](spark, SF).collect()
        assert rows and all(len(r.input_ids.split("\x01")) == len(r.labels.split("\x01")) == 128 for r in rows)


def test_json_array_cut_in_any_byte_range(spark, tmp_path):
    import json

    from millrace.sources import json_arrays as JA

    rows = [
        {"id": 1, "t": 'a "quoted" } { [ ] \\ text'},
        {"id": 2, "t": "back\\\\", "o": {"deep": [{"x": "}"}, {"y": 1}]}},
        {"id": 3, "t": ""},
        {"id": 4, "t": "é ü 漢字 }" * 5},
        {"id": 5, "t": 'ends in a backslash \\'},
        {"id": 6, "t": None},
    ]
    for k, text in enumerate([json.dumps(rows), json.dumps(rows, indent=2, ensure_ascii=False), "[]", "", '[1, "a } {", [2, {"id": 9}], {"id": 7}, null]\n[{"id": 8}]\n']):
        (tmp_path / f"f{k}.json").write_text(text, encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (9, 40, 1 << 20):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        fragments = JA._fragments(spark, str(tmp_path))  # written in ranges of this size
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        by_file = {}
        for r in sorted(JA._records(fragments).collect(), key=lambda r: (r["file"], r["record_no"])):
            by_file.setdefault(r["file"][-7:], []).append(json.loads(r["text"]))
        assert by_file == {"f0.json": rows, "f1.json": rows, "f4.json": [{"id": 7}, {"id": 8}]}, size
    ids = [r["id"] for r in JA.read_json_array(spark, str(tmp_path / "f1.json"), "id int, t string").collect()]
    assert sorted(ids) == [1, 2, 3, 4, 5, 6]


def test_trained_sentences_keep_abbreviations_whole(spark):
    from millrace.operators import sentence_model as SM

    names = ["Smith", "Jones", "Brown", "Miller"]
    plain = "We went to the house with dr {}. The garden was green. The house was old. The day was long. ".replace("dr ", "Dr. ")
    docs = [(i, plain.format(names[i % 4]) + f"We saw it, e.g. this tree. The price was 3.14 coins. The man was J. {names[i % 4]}. ") for i in range(40)]
    docs += [(200 + i, "An old green tree stands on a long way and Smith, Jones, Brown and Miller have no coins") for i in range(40)]
    docs += [(300, "It is the end of the house"), (301, "It is so"), (302, "It is no")]
    docs += [(100, None), (101, ""), (102, "  \n"), (103, "No end here"), (104, "Really?! Yes... and no. (So it is.) The end")]
    df = spark.createDataFrame(docs, "doc_id long, content string")
    model = SM.fit(df)
    known = {r["type"] for r in model.types.where("is_abbreviation").collect()}
    assert {"dr", "e.g"} <= known and not known & {"green", "old", "long", "tree", "coins"}
    assert "the" in {r["type"] for r in model.starters.collect()}
    got = {r["doc_id"]: r["sentences"] for r in SM.split_sentences(df, model).collect()}
    assert got[0] == [
        "We went to the house with Dr. Smith.", "The garden was green.", "The house was old.", "The day was long.",
        "We saw it, e.g. this tree.", "The price was 3.14 coins.", "The man was J. Smith.",
    ]
    assert got[100] == got[101] == got[102] == []
    assert got[103] == ["No end here"]
    assert got[104] == ["Really?!", "Yes... and no.", "(So it is.)", "The end"]
    empty = df.where("doc_id < 0")
    assert SM.split_sentences(df, SM.fit(empty)).count() == len(docs)


def test_trained_sentences_tell_each_word_of_a_slice_apart_once(spark, monkeypatch):
    from millrace.operators import sentence_model as SM

    docs = [(1, "One green. Two red!\u00a0No \n\t Three. "), (1, "Über alles. Mauerwerk. 7. haus"), (2, None), (3, " \t"), (None, "A window.\x0bC?"), (4, "a")]
    df = spark.createDataFrame(docs * 3 + [(5, "green green. Green. " * 200)], "doc_id long, content string")
    want = {"One green.", "Two red!\u00a0No \n\t Three.", "Über alles.", "Mauerwerk.", "7. haus", "A window.", "C?", "a", "green green.", "Green."}
    found = []
    for limit in (SM.TEXT_BYTES, 1):  # all texts in few slices, one text a slice
        monkeypatch.setattr(SM, "TEXT_BYTES", limit)
        model = SM.fit(df)
        rows = SM.split_sentences(df, model).collect()
        found.append(sorted(str(tuple(r)) for r in rows))
        assert len(rows) == df.count() and {s for r in rows for s in r.sentences} == want
        assert all(r.sentences == ["One green.", "Two red!\u00a0No \n\t Three."] for r in rows if r.doc_id == 1 and r.content.startswith("One"))
    assert found[0] == found[1]
    counts = {(r.a, r.b): r.n for r in SM._counts(df.coalesce(1), "content").collect()}
    assert counts["green.", None] == 203 and counts["green.", "Green."] == 200 and counts["Green.", "green"] == 199
    slices = SM._slices(df.where("doc_id = 5"), "content").collect()
    assert [len(r.pairs) for r in slices] == [2]  # 399 places, two pairs


def test_texts_of_several_megabytes_share_a_block_and_its_words(spark):
    from millrace.operators import relevance as REL

    own = ["river", "tower", "window", "garden"]
    docs = spark.range(4, numPartitions=1).selectExpr("id AS doc_id", "concat(repeat('house meadow ', 60000), element_at(array('river', 'tower', 'window', 'garden'), int(id) + 1)) AS content")
    model, blocks = REL.build_model(docs)
    words = sorted((r.token, r.df) for r in blocks.selectExpr("inline(words)").collect())
    assert words == sorted([("house", 4), ("meadow", 4), *((w, 1) for w in own)])  # 3 MB: a row a word
    query = REL.query_vector(spark, "river house tower", model.idf, name="qp")
    sums = {r.doc_id: (r.n2, r.dp, r.dn) for r in REL.corpus_sums(blocks, model.idf, query).collect()}
    assert set(sums) == {0, 1, 2, 3}
    assert all(abs(a - b) < 1e-9 for i in range(4) for a, b in zip(sums[i], (4.0, 2 ** 0.5 if i < 2 else 0.0, 0.0), strict=True))


def test_term_table_equals_a_walk_in_list_order(spark):
    import random
    import re

    from millrace.operators.terms import close_terms

    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)] + ["é", "Über"]
    terms = list({" ".join(rng.choices(words, k=rng.choice([2, 2, 3]))) for _ in range(400)})
    terms += [f"x{i} y{i}" for i in range(10000)] + ["one", "", "w1", None]
    texts = [rng.choice(["", " ", "\n"]) + "".join(rng.choice(words) + rng.choice([" "] * 8 + ["  ", ", "]) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    texts += [None, "", " ,", "x7 y7x7 y7 x7 y7", "w1"]

    def walk(text):
        if text is None:
            return None
        toks = re.findall(r"\w+|\W+", text)
        taken, gaps = set(), set()
        for t in terms:
            parts = re.findall(r"\w+|\W+", t or "")
            for i in range(len(toks) - len(parts) + 1 if len(parts) > 2 else 0):
                span = set(range(i, i + len(parts)))
                if toks[i : i + len(parts)] == parts and not span & taken:
                    taken |= span
                    gaps |= {i + k for k in range(1, len(parts), 2)}
        return "".join(t for i, t in enumerate(toks) if i not in gaps)

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string")
    table = spark.createDataFrame(list(enumerate(terms)), "ord int, term string")
    got = {r["doc_id"]: r["content"] for r in close_terms(df, table).collect()}
    assert got == {i: walk(t) for i, t in enumerate(texts)}
    assert close_terms(df, table.where("ord < 0")).count() == len(texts)


def test_tolerant_csv_counts_without_broken_lines(spark, tmp_path):
    from millrace.sources.io import read_csv_tolerant

    (tmp_path / "a.csv").write_text("1,a,5\n2,b,x\n3,c,7\n")
    df = read_csv_tolerant(spark, str(tmp_path), "id bigint, s string, n bigint", header=False)
    assert sorted(r["id"] for r in df.select("id").collect()) == [1, 3]
    assert spark.conf.get("spark.sql.csv.parser.columnPruning.enabled") == "true"


def test_packed_files(spark, tmp_path):
    from millrace.session import scratch_path
    from millrace.sources import packed as PK

    rows = [(f"f{i}", bytes([i % 256]) * (i % 90)) for i in range(300)] + [("big", b"\xff\x00" * 700), ("f1", b"again"), ("none", None), (None, b"x"), ("empty", b"")]
    files = spark.createDataFrame(rows, "path string, content binary").withColumn("name", F.lit("clash")).repartition(3)
    path = scratch_path(spark, "packed")
    index = PK.write_packed(files, path, max_bytes=1000)
    order = lambda r: (r[0] or "", r[1] or b"", r[1] is None)
    got = [(r.name, None if r.content is None else bytes(r.content)) for r in PK.read_packed(index, task_bytes=2500).collect()]
    assert sorted(got, key=order) == sorted(rows, key=order)
    sizes = {r.container: (r.n, r.b) for r in index.where("container is not null").groupBy("container").agg(F.count("*").alias("n"), F.sum("length").alias("b")).collect()}
    assert all(b <= 1000 or n == 1 for n, b in sizes.values())
    assert len(sizes) <= 2 * sum(len(c or b"") for _, c in rows) / 1000 + 3
    some = PK.read_packed(PK.open_packed(spark, path).where("name in ('big', 'f7')"))
    assert sorted((r.name, len(r.content)) for r in some.collect()) == [("big", 1400), ("f7", 7)]
    assert PK.read_packed(PK.write_packed(files.limit(0), scratch_path(spark, "packed"))).count() == 0


def test_pack_directory(spark, tmp_path):
    from millrace.session import scratch_path
    from millrace.sources import packed as PK

    for i in range(20):
        (tmp_path / f"{i}.txt").write_bytes(f"file {i}\n".encode())
    (tmp_path / "other.bin").write_bytes(b"\x00")
    index = PK.pack_directory(spark, str(tmp_path), scratch_path(spark, "packed-dir"), "*.txt")
    got = {r.name.rsplit("/", 1)[1]: bytes(r.content) for r in PK.read_packed(index).collect()}
    assert got == {f"{i}.txt": f"file {i}\n".encode() for i in range(20)}


def test_one_segment_below(spark):
    urls = ["https://a.org/x", "https://a.org/", "https://a.org/x/", "https://a.org/x/y", "https://b.org/x", "see https://a.org/x", None]
    df = spark.createDataFrame([(u,) for u in urls], "v string")
    got = [r[0] for r in df.select(U.one_segment_below("v", "https://a.org/")).collect()]
    assert got == [True, False, False, False, False, False, False]


def test_saved_model_is_loaded_whole(spark):
    from millrace.operators import relevance as REL
    from millrace.session import scratch_path

    docs = spark.createDataFrame([(1, "alpha beta\ngamma"), (2, "alpha beta"), (3, "beta delta delta"), (4, "")], "doc_id long, content string")
    model, bags = REL.build_model(docs)
    path = scratch_path(spark, "model-test")
    REL.save_model(model, bags, path)
    again, loaded = REL.load_model(spark, path)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(again.idf) == rows(model.idf) and again.n_docs == model.n_docs == 4
    assert rows(again.dictionary) == rows(model.dictionary)
    assert rows(REL.corpus_bow(loaded)) == rows(REL.corpus_bow(bags))
    # a word that the saved dictionary no longer holds is unknown to the loaded model
    fewer = scratch_path(spark, "model-test")
    REL.save_model(REL.RelevanceModel(model.dictionary.where("token <> 'delta'"), model.idf, 4), bags, fewer)
    assert "delta" in dict(rows(model.idf)) and "delta" not in dict(rows(REL.load_model(spark, fewer)[0].idf))


def test_prompt_mask(spark):
    recs = spark.createDataFrame([("say", "x y", "the answer"), ("say", "long " * 30, "cut"), ("say", None, None)], "instruction string, input string, output string")
    rows = B.instruction_examples(recs, "Do {}\nAnswer: {} end", 16, mask_prompt=True).collect()
    labels = [x for x in rows[0]["labels"] if x != A.IGNORE_LABEL]
    assert "".join(labels) == " the answer end" and rows[0]["input_ids"][0] == A.START_TOKEN
    assert set(rows[1]["labels"]) == {A.IGNORE_LABEL} and len(rows[1]["labels"]) == 16
    plain = B.instruction_examples(recs, "Do {}\nAnswer: {} end", 16).collect()
    assert [r["input_ids"] for r in plain] == [r["input_ids"] for r in rows]
    assert [x for x in plain[0]["labels"] if x != A.IGNORE_LABEL][0] == A.START_TOKEN


def test_distinct_rows(spark, monkeypatch):
    from millrace.operators import assembly as AS

    rows = [("a", None, 1.0), ("a", "", 1.0), ("a", None, 1.0), (None, "a", 0.0), (None, "a", -0.0), ("1:a", "b", None)] + [("hot", "x" * 500, 2.0)] * 200
    df = spark.createDataFrame(rows, "u string, v string, w double").repartition(5)
    want = sorted(map(str, df.dropDuplicates().collect()))
    assert sorted(map(str, AS.distinct_rows(df).collect())) == want and len(want) == 5
    assert AS.distinct_rows(df.limit(0)).count() == 0
    monkeypatch.setattr(AS, "bounded_broadcast", lambda _: None)
    assert sorted(map(str, AS.distinct_rows(df).collect())) == want


def test_assembly_takes_answers(spark):
    from millrace.operators import assembly as AS

    results = spark.createDataFrame([("u", "s", "raw", "t", 3, "clean", 0.5), ("v", "s", "raw", "t", 3, "", 0.5), ("w", None, "raw", "t", 3, "clean", 0.5)],
                                    "url string, source string, content string, task string, total_tokens long, generated_text string, costs double")
    raw = spark.createDataFrame([("p", "s", "one two"), ("p", "s", "one two"), ("q", None, "x")], "url string, source string, content string").withColumn("task", F.lit("clash"))
    got = lambda **k: sorted((r.url, r.content, r.task, r.generated_text) for r in AS.assemble([AS.Part(results, True, True), AS.Part(raw)], **k).collect())
    assert got() == [("p", "one two", "", ""), ("q", "x", "", ""), ("u", "clean", "t", ""), ("v", "raw", "t", "")]
    assert got(cleaned=False)[2] == ("u", "raw", "t", "clean")
    assert got(max_tokens=1, target_tokens=1)[0][1] == "one"


def test_stems_keep_rows_of_repeated_and_null_ids(spark, monkeypatch):
    from millrace.operators import joins as J
    from millrace.operators import stemming as ST

    rows = [(1, "The running laws, laws"), (2, None), (3, "of the"), (4, "cats the dogs"), (4, "flying high"), (None, "ponies"), (None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(1, "run laws, law"), (2, ""), (3, ""), (4, "cat fly high dog"), (None, "poni"), (None, ""), (None, "")]
    got = lambda: sorted(((r.doc_id, r.stemmed) for r in ST.stem_text(df, "doc_id", "text").collect()), key=str)
    assert got() == sorted(want, key=str)
    once = df.where("doc_id < 4")
    plan = ST.stem_text(once, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # no row of words is shuffled


def test_layered_join_has_every_row(spark):
    from millrace.operators import joins as J

    big = spark.createDataFrame([(i, w) for i in range(64) for w in ("hot", f"w{i % 8}", f"rare{i}", "unknown")], "id long, token string")
    small = spark.createDataFrame([("hot", 6.0)] + [(f"w{i}", 3.0) for i in range(8)] + [(f"rare{i}", 0.0) for i in range(64)], "token string, often double")
    rows = lambda df: sorted(map(str, df.select("id", "token").collect()))
    want = rows(big.where("token <> 'unknown'"))
    for limit in (0, 60, 600, 1 << 20):  # nothing, one word, nine words, all of them broadcast
        for how in ("inner", "left_semi"):
            assert rows(J.layered_join(big, small, "token", F.col("often"), how, limit)) == want


def test_bags_are_those_of_the_columns(spark):
    from millrace.operators import relevance as REL

    texts = ["The law\nof the land, LAW of the\x1cNight", "of the\nof the", "", None, "ΟΔΟΣ Straße_2 İx ½ áb", "x " * 50]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, content string")
    terms = ["of the", "the land"]
    merged = T.join_lines(T.close_composite_terms(F.coalesce("content", F.lit("")), terms))
    want = {r.doc_id: (sorted(r.m), set(r.w)) for r in df.select("doc_id", T.kept_words(merged).alias("m"), T.kept_words(F.coalesce("content", F.lit(""))).alias("w")).collect()}
    for r in REL.document_bags(df, composite_terms=terms).collect():
        words, raw = want[r.doc_id]
        assert sorted(b.token for b in r.bag for _ in range(b.tf)) == words
        assert set(r.added) == raw - set(words) and set(r.glued) == set(words) - raw


def test_blocks_hold_the_bags_of_the_columns(spark, monkeypatch):
    import math
    from collections import Counter

    import pytest

    from millrace.operators import bags as BG
    from millrace.operators import relevance as REL

    texts = ["The law\nof the land, LAW of the\x1cNight", "of the\nof the", "", None, "ΟΔΟΣ Straße_2 İx ½ áb (law) a-b", "law night " * 50, "the, law", "night\nland"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, "land law"), (None, "night sea")]
    df = spark.createDataFrame(rows, "doc_id long, content string").coalesce(1)
    terms = ["of the", "the land"]
    merged = T.join_lines(T.close_composite_terms(F.coalesce("content", F.lit("")), terms))
    own = df.select("doc_id", T.kept_words(merged).alias("m"), T.kept_words(F.coalesce("content", F.lit(""))).alias("w")).collect()
    bags, raw = [(r.doc_id, Counter(r.m)) for r in own], {w for r in own for w in r.w}
    for limit in (BG.BLOCK_BYTES, 1):  # all texts in one block, one text a block
        monkeypatch.setattr(BG, "BLOCK_BYTES", limit)
        model, blocks = REL.build_model(df, composite_terms=terms)
        assert blocks.count() == (1 if limit > 1 else 9)  # an empty text and the next share a block
        # a word of many texts has one row a block where it is counted
        hot = blocks.select(F.inline("words")).where("token = 'law' and df > 0").collect()
        assert sum(r.df for r in hot) == 5 and len(hot) == (1 if limit > 1 else 5)
        want = sorted(str((i, w, n)) for i, b in bags for w, n in b.items())
        assert sorted(str(tuple(r)) for r in REL.corpus_bow(blocks).collect()) == want
        known = sorted(str((i, w, n)) for i, b in bags for w, n in b.items() if w in raw)
        assert sorted(str(tuple(r)) for r in REL.known_bow(blocks, model.dictionary).collect()) == known != want
        assert {r.token for r in model.dictionary.collect()} == raw
        df_of = Counter(w for _, b in bags for w in b if w in raw)
        idf = {w: math.log2(len(rows) / n) for w, n in df_of.items()}
        sums = {}
        for i, b in bags:
            if known_words := [w for w in b if w in idf]:
                sums[i] = sums.get(i, 0) + sum((b[w] * idf[w]) ** 2 for w in known_words)
        for broadcast in (REL.bounded_broadcast, lambda _: None):
            monkeypatch.setattr(REL, "bounded_broadcast", broadcast)
            got = {r.doc_id: r.n2 for r in REL.corpus_sums(blocks, model.idf).collect()}
            assert got == pytest.approx(sums)
        monkeypatch.undo()
        query = REL.query_vector(spark, "law law night", model.idf, name="qp")
        q = {r.token: r.qp for r in query.collect()}
        dp = {r.doc_id: r.dp for r in REL.corpus_sums(blocks, model.idf, query).collect()}
        assert dp[6] == pytest.approx(sum(dict(bags)[6][w] * idf[w] * q[w] for w in q)) and set(q) == {"law", "night"}
    empty, none = REL.build_model(df.where("doc_id < 0"))
    assert empty.n_docs == REL.corpus_bow(none).count() == REL.corpus_sums(none, empty.idf).count() == 0


def test_words_are_counted_once_and_sent_back_to_their_blocks(spark, monkeypatch):
    import pytest

    from millrace.operators import bags as BG
    from millrace.operators import relevance as REL

    rows = [(i, f"law night w{i % 5} only{i}\nland") for i in range(40)] + [(3, "night of the land"), (None, "law law"), (50, "")]
    df = spark.createDataFrame(rows, "doc_id long, content string").coalesce(2)
    monkeypatch.setattr(BG, "BLOCK_BYTES", 200)
    monkeypatch.setattr(REL, "PART_WORDS", 7)
    model, blocks = REL.build_model(df, composite_terms=["of the"])
    vectors = [REL.query_vector(spark, q, model.idf, name=n) for q, n in (("law night only3", "qp"), ("w1 law absent", "qn"))]
    rows_of = lambda df: {r.doc_id: (r.n2, r.dp, r.dn) for r in df.collect()}
    for q in ([], vectors[:1], vectors):
        got, want = (rows_of(REL.corpus_sums(blocks, m, *q)) for m in (model, model.idf))
        assert got.keys() == want.keys() and len(got) == 41
        assert all(got[i] == pytest.approx(want[i]) for i in want)
    # the words of all blocks are read again for the query vectors only, and none is shuffled
    plan = REL.corpus_sums(blocks, model)._jdf.queryExecution().optimizedPlan().toString()
    assert "token" not in plan and "words" in plan
    # a part holds its words once, however many blocks they are in
    counts = [r.token for r in model.counts.collect()]
    assert len(counts) == len(set(counts)) and {r.token: r.df for r in model.counts.collect()}["law"] == 41


def test_blocks_cut_texts_once_where_terms_meet():
    import numpy as np
    import pyarrow as pa
    from collections import Counter

    from millrace.operators import bags as BG

    texts = ["x of the th y of\nthe", "of the th", "\x02\x03 a\x02\x03b\nc", "ΟΔΟΣ\nΒ ΟΔΟΣ of theΣ", "a\n\nb", "\n", "", "İx\nİ the\nof"]
    stop = frozenset(T.STOP_WORDS)
    cut = lambda t: BG._words(t.lower().split(), stop)
    for terms in ([], ["of the"], ["of the", "ofthe th"], ["a b", ""], [" of "]):
        for own in (texts, *[[t] for t in texts], []):
            merged = own
            for t in [*terms, "\n"]:
                merged = [m.replace(t, t.replace(" ", "").replace("\n", "")) for m in merged]
            words, known, sizes, at, tf = BG._block(pa.array(own, pa.large_string()), stop, terms, True, True)
            words, ends = words.to_pylist(), np.cumsum(sizes)
            bags = [{words[w]: n for w, n in zip(at[lo:hi], tf[lo:hi])} for lo, hi in zip(ends - sizes, ends)]
            assert bags == [Counter(cut(m)) for m in merged]
            assert {w for w, k in zip(words, known) if k} == {w for t in own for w in cut(t)}
    for kind, values in (("<i4", [0, -1, 2**31 - 1]), ("<i8", [2**40]), ("<i4", [])):
        assert BG.unpack(pa.scalar(BG.pack(np.array(values, int), kind)), kind).tolist() == values


def test_token_counts_without_arrays(spark):
    texts = ["", " ", "a", " a", "a ", "a b\n", " ", "a  ", "x " * 100, "x " * 100 + "y", "x " * 99 + "y"]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    for r in df.select("t", T.token_count("t").alias("n"), F.regexp_count("t", F.lit(T.PIECE_PATTERN)).alias("w"),
                       T.more_tokens_than("t", 100).alias("a"), T.more_tokens_than("t", 0).alias("b")).collect():
        assert r.n == r.w and (r.t is None or (r.a, r.b) == (r.w > 100, r.w > 0))


def test_commits_side_by_side(spark, tmp_path):
    import pytest

    log, run, asked, flag = _job(spark, tmp_path, stop="text 10")
    with pytest.raises(Exception):
        run(at_once=3)
    assert log.results().count() < 20
    flag.unlink()
    run(at_once=3)
    assert sorted(r.generated_text for r in log.results().collect()) == [f"ok text {i:02}" for i in range(20)]
    assert log.manifest().count() == 5 and run(at_once=3) == []
