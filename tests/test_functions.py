"""Functions against small cases and plain Python."""

import collections
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import identifiers as I
from millrace.functions import quality as Q
from millrace.functions import text as T
from millrace.operators import chunking as K
from millrace.operators import citations as C
from millrace.operators import formulas as M
from millrace.operators import layout as L
from millrace.operators import papers as P
from millrace.operators import relational as R
from millrace.operators import reports
from millrace.operators import structure as S
from millrace.operators import vectors as V
from millrace.plans import catalogue
from millrace.sources import readers
from millrace.streaming import incremental


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(("text", "want"), [("", ""), ("a  b\t\tc", "a b c"), ("x\n\n\n\ny", "x\n\ny"), ("a b", "a b")])
def test_whitespace(spark, text, want):
    assert one(spark, T.normalise_whitespace(F.lit(text))) == want


def test_clean_drops_repeated_titles_and_page_numbers(spark):
    text = "A long running title\nwords\n12\nA long running title\nmore\nPage 3\nA long running title\nA long running title\nend"
    assert one(spark, T.clean(F.lit(text))) == "A long running title\nwords\nmore\nend"


def test_html(spark):
    assert one(spark, T.strip_html(F.lit("<b>a &amp; b</b>"))) == "a & b"
    assert one(spark, T.unescape(F.lit("&eacute;&#33;"))) == "é!"


def test_header_goes_before_the_cleaned_text(spark):
    # the fixers once put it before the text as it was
    chunks = spark.createDataFrame([(1, 0, "<p>" + "word " * 20 + "</p>", "T", "S")], "doc_id long, chunk_index int, text string, title string, section string")
    got = K.fix_pipeline(chunks).first().text
    assert got.startswith("# T\n\n## S\n\nword") and "<p>" not in got


@pytest.mark.parametrize(("text", "want"), [("https://x.y", "url"), ("[1] a", "citation"), ("Table 2", "table"), ("plain", "text")])
def test_content_type(spark, text, want):
    assert one(spark, T.content_type(F.lit(text))) == want


def test_orcid_uses_the_standard_check_digit(spark):
    assert one(spark, I.orcid_valid(F.lit("0000-0002-1825-0097"))) is True
    assert one(spark, I.orcid_valid(F.lit("0000-0002-1694-233X"))) is True
    assert one(spark, I.orcid_valid(F.lit("0000-0002-1825-0098"))) is False


@pytest.mark.parametrize(("i", "year"), [("2505.01754", 2025), ("hep-th/9901001", 1999), ("0704.0001", 2007)])
def test_arxiv_year(spark, i, year):
    assert one(spark, I.arxiv_year(F.lit(i))) == year


def test_citation_positions(spark):
    text = "See [1] and [2,3], not [2, 3x]. [1001] too (7)"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = [(r.mark, r.position, r.numbers) for r in C.citations(df).orderBy("place").collect()]
    # marks in round brackets count too, those without a number from 1 to 1000 don't
    want = [(m.group(), m.start()) for m in re.finditer(r"\[\d+(?:[, \-]\d+)*\]|\(\d+(?:[, \-]\d+)*\)", text) if "1001" not in m.group()]
    assert [g[:2] for g in got] == want and len(want) == 3
    assert [g[2] for g in got] == [[1], [2, 3], [7]]


def test_windows_go_on_to_the_end():
    text = "word " * 300
    for size, overlap in ((60, 50), (100, 99), (512, 50), (50, 60)):
        spans = K.fixed_spans(text, size, overlap, least=1, most=2 * size)
        assert spans[-1][1] == len(text) and all(a[0] < b[0] <= a[1] for a, b in zip(spans, spans[1:]))


def test_pages_take_the_lines_of_the_cleaned_text(spark):
    df = spark.createDataFrame([([(1, "a\nb"), (2, "c"), (3, "d\ne")], "A\nB\nC\nD\nE\nF")], "pages array<struct<page int, text string>>, text string")
    got = df.select(P.pages_of_cleaned(F.col("pages"), F.col("text")).alias("p")).first().p
    assert [(r.page, r.text, r.char_count) for r in got] == [(1, "A\nB", 3), (2, "C", 1), (3, "D\nE\nF", 5)]


def test_places_outside_all_spans(spark):
    chunks = spark.createDataFrame([(1, 0, 0, 5), (1, 1, 12, 40), (2, 0, 0, 9)], "doc_id long, chunk_index int, char_start int, char_end int")
    sections = spark.createDataFrame([(1, 3, 10, "A"), (1, 15, 30, "B")], "doc_id long, start long, end long, section string")
    pages = spark.createDataFrame([(1, 0, 10, 1), (1, 12, 30, 2)], "doc_id long, start long, end long, page int")
    got = sorted((r.chunk_id, r.section, r.page, r.section_end, r.page_end) for r in P.annotated(chunks, sections, pages).collect())
    assert got == [("1_chunk_0", "Unknown", 1, "A", 1), ("1_chunk_1", "Unknown", 2, "B", 2), ("2_chunk_0", "Unknown", 1, "Unknown", 1)]


def test_references(spark):
    df = spark.createDataFrame([(1, 'References\n[1] A. Bee. "On things". 2001. arXiv:2001.00001\nmore\n[2] C. Dee. Other words that are long. 1999')], "doc_id long, text string")
    r = {x.ref_id: x for x in C.references(df).collect()}
    assert r["1"].title == "On things" and r["1"].year == 2001 and r["1"].arxiv_id == "2001.00001" and r["2"].year == 1999


def test_formulas_come_back(spark):
    t = F.lit("a $x=1$ b $$y$$ c \\[z+1\\]")
    assert one(spark, M.restore(M.preserve(t)["text"], M.preserve(t)["formulas"])) == "a $x=1$ b $$y$$ c \\[z+1\\]"


@pytest.mark.parametrize("text", ["", "short", "One. " * 400, "nospace" * 300, "A sentence here! " * 90 + "x" * 2000, "tête über. 😀 " * 200])
def test_fixed_windows_cover_the_text(text):
    spans = K.fixed_spans(text)
    for (_, e), (s, _) in zip(spans, spans[1:], strict=False):
        assert s == e - K.OVERLAP
    if len(text.strip()) >= K.LEAST and spans:
        assert spans[0][0] == 0


def python_pack(sentences, size, overlap):
    out, cur, n = [], [], 0
    for s in sentences:
        if cur and n + len(s) > size:
            out.append(" ".join(cur))
            kept, m = [], 0
            for x in reversed(cur):
                if m + len(x) > overlap:
                    break
                kept.insert(0, x)
                m += len(x) + 1
            cur, n = kept, m
        cur.append(s)
        n += len(s) + 1
    return [*out, " ".join(cur)] if cur else out


@pytest.mark.parametrize("text", ["", "One two. " * 100, "A. Bb. Ccc ddd. " * 70 + "Long one without end " * 60, "Ein Satz! Noch einer? " * 50])
def test_sentence_packing(spark, text):
    want = python_pack([s for s in (x.strip() for x in re.split(r"(?<=[.!?])\s+", text)) if s], 512, 50)
    assert one(spark, K.packed(T.sentences(F.lit(text)), 512, 50)) == want


@pytest.mark.parametrize("text", ["short", "para one.\n\n" * 300, "Word. " * 500, "x" * 3000, ("a" * 900 + "\n\n") * 4])
def test_split_long(spark, text):
    got = one(spark, K.split_long(F.lit(text), 1500))
    assert "".join("".join(got).split()) == "".join(text.split())
    assert len(text) <= 1500 or len(got) >= 1


def test_sections_after_each_other(spark):
    # a header right after a header opens its own section
    df = spark.createDataFrame([(1, "Lead in words\nAbstract\nIntroduction\nbody\n2. Methods\nhow\nReferences\n[1] x")], "doc_id long, text string")
    got = {r.section: r.text for r in S.sections(df).collect()}
    assert got["Methods"] == "how" and "body" in got["Introduction"]


def test_sections_offsets(spark):
    text = "Lead\nAbstract\nabc\nResults\ndef"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    for r in S.sections(df).collect():
        assert text[r.start_char : r.end_char] == r.text


def test_tables(spark):
    rows = [["a", "b|c"], ["1", "2"]]
    assert one(spark, L.markdown(F.lit(rows))) == "| a | b\\|c |\n| --- | --- |\n| 1 | 2 |"
    assert one(spark, L.has_header(F.lit(rows))) is True
    assert one(spark, F.size(L.merged(F.array(F.lit(rows), F.lit([["3", "4"]]))))) == 1


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_numbered(spark, n):
    got = R.numbered(spark.range(n).withColumnRenamed("id", "k"), ["k"]).collect()
    assert sorted((r.k, r.position) for r in got) == [(i, i) for i in range(n)]


def test_interval_join_matches_brute_force(spark):
    spans = [(1, 0, 10), (1, 10, 3000), (2, 5, 6), (2, 7, 7)]
    points = [(1, 0), (1, 9), (1, 10), (1, 2999), (1, 3000), (2, 5), (2, 7)]
    got = R.interval_join(spark.createDataFrame(points, "k int, p long"), spark.createDataFrame(spans, "k int, s long, e long"), "k", "p", "s", "e").collect()
    assert sorted((r.k, r.p, r.s) for r in got) == sorted((k, p, s) for k, p in points for j, s, e in spans if j == k and s <= p < e)


def test_sidecar(spark):
    got = readers.sidecar(spark.createDataFrame([("Title: A: b\nAuthors: X\nbad line\nTITLE: second wins",)], "value string")).first().meta
    assert got == {"title": "second wins", "authors": "X"}


def test_ids(spark):
    got = readers.parse_ids(spark.createDataFrame([("cs.AI|2505.01754",), ("2505.01754",), ("",), ("cs.XX|1",)], "value string"), ["cs.AI", "cs.LG"]).collect()
    assert sorted(map(tuple, got)) == [("cs.AI", "2505.01754"), ("cs.AI", "2505.01754"), ("cs.LG", "2505.01754")]


def test_extractors(spark):
    got = {r.path: r for r in readers.extract(spark.createDataFrame([("a", b"<p>x &amp; y</p>"), ("b", b"  ")], "path string, content binary")).collect()}
    assert got["a"].success and got["a"].text == "x & y" and not got["b"].success


def test_empty_document_scores_nothing(spark):
    pages = F.array().cast("array<struct<page:int,text:string,char_count:int>>")
    assert one(spark, Q.extraction_score(F.lit(""), pages)) == 0.0


def test_metadata_score_has_a_fixed_denominator(spark):
    none = F.lit(None).cast("string")
    assert one(spark, Q.metadata_score(none, F.lit("An author"), F.lit(3), none, none, none)) == pytest.approx(0.4)


def test_upserts_are_idempotent(spark, tmp_path):
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, t int").write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        src = spark.readStream.schema("k int, v string, t int").parquet(str(tmp_path / "in"))
        incremental.upsert_stream(src, ["k"], ["t"], str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert sorted((r.k, r.v) for r in incremental.current(spark, str(tmp_path / "t"), ["k"], ["t"]).collect()) == [(1, "b"), (2, "c")]


def test_eviction_keeps_the_last_used(spark):
    c = spark.sql("SELECT concat('k', id) AS cache_key, 10L AS size, timestamp_seconds(id * 50000) AS last_accessed FROM range(20)")
    assert incremental.evict(c, 1000).count() == 20
    assert sorted(int(r.cache_key[1:]) for r in incremental.evict(c, 100).collect()) == list(range(12, 20))


def test_nearest_of_every_fiftieth_row_collects_no_vectors(spark, monkeypatch):
    import numpy as np
    from pyspark.sql import DataFrame

    from millrace.operators import vectors

    x = np.random.default_rng(3).normal(size=(500, 8))
    base = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<float>")
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    want = {(i, r + 1, j) for i in range(0, 500, 50) for r, j in enumerate([j for j in np.lexsort((np.arange(500), -np.round(u @ u[i], 6))).tolist() if j != i][:5])}
    monkeypatch.setattr(type(base), "toPandas", None)
    got = vectors.nearest(base.where("id % 50 = 0"), base, 5, rows=64).collect()
    assert isinstance(base, DataFrame) and {(r.query_id, r.rank, r.vec_id) for r in got} == want


def test_config(tmp_path):
    from millrace.config import Config

    p = tmp_path / "c.yaml"
    p.write_text('# all\npaths:\n  pdf_dir: "/x"\n\nchunking:\n  chunk_size: 1024  # tokens\n  chunk_overlap: 100\ntext:\n  max_chunk_size: 1500\nmax_retries: 5\n')
    c = Config.load(str(p))
    assert (c.chunk_size, c.chunk_overlap, c.max_chunk_size, c.max_retries, c.min_chunk_size) == (1024, 100, 1500, 5, 200)


def test_failures_of_an_encoder_are_told(spark):
    from millrace.operators import vectors as V

    def make():
        def run(texts):
            if any("bad" in t for t in texts):
                raise ValueError("no such word")
            return [[3.0, 4.0]] * len(texts)

        return run

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, None)], "i int, t string").coalesce(1)
    got = {r.i: (r.embedding, r.err) for r in V.encode(df, "t", make, 2, failed="err").collect()}
    assert got[2] == ([0.0, 0.0], "ValueError: no such word") and got[3][1] is None and got[1][0] == pytest.approx([0.6, 0.8])


def test_word_boundaries_are_those_of_sql(spark):
    # after a letter beyond ASCII, RE2 sees a word begin, Java 17 does not
    duck = duckdb.connect()
    for text in ("éa Bc " * 6, "xa Bc " * 6, "_a Bc " * 6, " a Bc " * 6):
        want = duck.execute(catalogue.oracle_sql()["artifact_flags"].replace("FROM documents", "FROM (SELECT 1 AS doc_id, $t AS text)"), {"t": text}).fetchone()[1]
        assert one(spark, T.artifact_flags(F.lit(text))) == want
    docs = spark.createDataFrame([(1, "éFigure 3, xFigure 4, Figure 5")], "doc_id long, text string")
    assert sorted(r.number for r in S.mentions(docs).collect()) == ["3", "5"]
    assert one(spark, M.counts(F.lit("\\fracé \\fracx \\frac1 \\sum_"))["command"]) == 1


def test_first_spans_are_those_of_sql(spark, tmp_path):
    # marks without a number from 1 to 1000 and missing texts once had no row, texts of one doc_id one together
    rows = [(0, "a [1001] é(0) and [0, 5] [1001]"), (1, None), (2, "(99999999999) [2024]"), (3, ""), (3, "other (7)"), (3, "")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("citation_first_span", "citation_mentions"):
        got = catalogue.queries()[name](spark, str(tmp_path))
        assert sorted(map(tuple, got.collect())) == sorted(duck.execute(catalogue.oracle_sql()[name]).fetchall())
    assert catalogue.queries()["citation_first_span"](spark, str(tmp_path)).where("mark in ('[1001]', '(0)', '(99999999999)')").count() == 3


def test_keywords_are_counted_beside_their_text(spark, tmp_path):
    # every word was a row of an aggregate once, which spilled far more than the texts
    rows = [(i % 7, "Wörter words über Words four five six " * (i % 5) + f"only{i} é1_é2 " * 3 + "the end " * 30) for i in range(40)] + [(7, None), (8, ""), (9, "one four"), (10, "Äpfel bbbb cccc dddd " + "x " * 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = reports.keyword_fallback(docs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "HashAggregate" not in plan and plan.count("Exchange") <= 2

    def plain(texts):
        n, first = collections.Counter(), {}
        for t in texts:
            for i, w in enumerate(re.findall(r"\w+", t.lower())):
                if len(w) >= 4:
                    n[w] += 1
                    first[w] = min(i, first.get(w, i))
        sizes = {len(re.findall(r"\w+", t)) for t in texts}
        return {z: [(w, n[w]) for w in sorted((w for w in n if n[w] < 0.05 * z), key=lambda w: (-n[w], first[w], w.encode()))[:10]] for z in sizes}

    for d in {i for i, _ in rows}:
        mine = [(r.word, r.n) for r in got.where(f"doc_id = {d}").orderBy("rank").collect()]
        assert mine in [*plain([t for i, t in rows if i == d and t is not None]).values(), *([[]] if d == 7 else [])]


def test_tasks_of_a_layout_are_bounded(spark, monkeypatch):
    # the number of tasks once stayed the same however many blocks there were
    monkeypatch.setattr(L, "ROWS", 50, raising=False)
    n = F.col("id")
    blocks = spark.range(1000).select((n / 5).cast("long").alias("page"), (n % 2 * 300.0).alias("x0"), (n % 5 * 40.0).alias("y0"), (n % 2 * 300.0 + 200).alias("x1"), (n % 5 * 40.0 + 12).alias("y1"), n.cast("string").alias("text"))
    for got in (L.reading_order(blocks, ["page"]), L.with_columns(blocks, ["page"])):
        sizes = got.groupBy(F.spark_partition_id()).agg(F.countDistinct("page").alias("n")).collect()
        assert sum(r.n for r in sizes) == 200 and len(sizes) > 15 and max(r.n for r in sizes) <= 30


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_chunks_are_cleaned_and_split_once(spark):
    # an inferred filter once held the whole cleaning some dozen times over
    chunks = spark.createDataFrame([(1, 0, "One two. " * 400, "T", "S"), (2, 0, None, "T", "S")], "doc_id long, chunk_index int, text string, title string, section string")
    got = K.fix_pipeline(chunks)
    assert optimized(got).count("<[^>]+>") == 1 and optimized(got).count("aggregate(split(text") == 1
    assert {r.doc_id for r in got.collect()} == {1} and {r.doc_id for r in K.parts_of_chunks(chunks).collect()} == {1}


def test_abstracts_are_looked_for_once(spark):
    # each check once looked for every place again
    docs = spark.createDataFrame([(1, "Abstract: We propose a novel method and our results show that it works well.\n\n1 Introduction\nwords"), (2, None), (3, "short")], "doc_id long, text string")
    got = docs.select("doc_id", S.abstract(F.col("text")).alias("a")).select("doc_id", "a.text", "a.confidence")
    assert optimized(got).count("summary") == 1 and optimized(got).count("introduction") == 1
    found = {r.doc_id: r for r in got.collect()}
    assert found[1].text.startswith("We propose") and found[1].confidence == pytest.approx(0.93) and found[2].text is None and found[3].text is None


def test_headings_are_prepared_once(spark):
    # every name once prepared the line again
    docs = spark.createDataFrame([("2. Related Work",), ("IV) RESULTS:",), ("[1] x y",), ("Methods of note",), ("methods of note",), (None,), ("words",)], "x string")
    got = docs.select("x", S.heading_name(F.col("x")).alias("n"))
    assert optimized(got).count("section[") == 1
    assert {r.x: r.n for r in got.collect()} == {"2. Related Work": "Related Work", "IV) RESULTS:": "Results", "[1] x y": "References", "Methods of note": "Methods", "methods of note": None, None: None, "words": None}


def test_encoders_get_bounded_lists(spark):
    # they once got whole Arrow batches
    small = spark.range(5000).select("id", F.when(F.col("id") % 7 > 0, F.lit("x" * 10)).alias("t"))
    docs = small.union(spark.range(3).select("id", F.lit("y" * 700000).alias("t"))).coalesce(1)

    def make():
        return lambda texts: [[len(texts), 1 + (sum(map(len, texts)) > 1 << 20)] for _ in texts]

    got = V.encode(docs, "t", make, 2).select("embedding").collect()
    assert len(got) == 5003 and all(1 <= round(r.embedding[0] / r.embedding[1], 2) <= 1024 for r in got)
    alone = [r.embedding for r in got[-2:]]
    assert all(e[0] == pytest.approx(e[1]) for e in alone)


def test_breaks_by_similarity_stay_beside_their_text(spark, monkeypatch):
    # sentences with their vectors were once rows that were dealt out and sorted
    monkeypatch.setattr(V, "PIECE", 3, raising=False)
    texts = ["The cat sat on a mat. The cat sat on a mat too. Quite other words here! Quite other words here? " * k for k in range(4)] + [None, "short. tiny."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = K.by_similarity(docs, most=90, dim=64)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    model = V.hashing_encoder(64)()
    for d, text in enumerate(texts):
        want, cur, last = [], "", None
        for s in [x for x in re.findall(r"[^.!?]+[.!?]", text or "") for x in [x.strip()] if len(x) > 10]:
            v = model([s])[0] / np.linalg.norm(model([s])[0])
            if cur and (float(v.astype(float) @ last.astype(float)) < 0.7 or len(cur) + 1 + len(s) > 90):
                want.append(cur)
                cur = ""
            cur, last = f"{cur} {s}".strip(), v
        assert [r.text for r in got.where(f"doc_id = {d}").orderBy("chunk_index").collect()] == want + [cur] * bool(cur)
