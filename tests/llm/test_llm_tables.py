"""Archives, rollups, vectors and the pipeline against plain versions."""

import gzip
import hashlib
import io
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleanery.llm import archive, language, packing, pii, quality, rollup, vectors
from test_llm_near_copies import kept_by_brute_force

SF = "/root/testdata/sf0.001"

# --- archives -----------------------------------------------------------------------

PAGES = [
    (3, "http://a.example/x y", "<p>" + "same " * 40), (1, "http://b.example/", "<p>" + "same " * 40), (2, None, "<p>" + "same " * 40),
    (None, "http://n.example/", "<p>" + "same " * 40), (4, "", None), (5, "http://c.example/é\n", ""), (6, "u", "short"), (7, "u", "short"),
    (8, "u", "HTTP/1.1 200 OK\r\n\r\nin the text " * 9), (9, "u", "ü" * 50), (10, "u", "ü" * 50), (11, "u", "ü" * 49), (12, "u", "ü" * 49),
    (1, "http://b.example/", "<p>" + "same " * 40), (13, "u", "long " * 100_000),
]


@pytest.mark.parametrize("versions", [(1,), (2,), (1, 2)])
def test_archives(spark, tmp_path, monkeypatch, versions):
    df = spark.createDataFrame([(*p, 0) for p in PAGES], "page_id long, url string, html string, n int").repartition(3)
    arcs = archive.write_arcs(df, str(tmp_path / "arc"), versions=versions)
    rows = archive.read_warcs(spark, str(tmp_path / "warc"), archive.convert(spark, str(tmp_path / "arc"), arcs, str(tmp_path / "warc"))).collect()
    want = []
    least = {}
    for k, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0])):
        body = (html or "").encode()
        digest = hashlib.sha256(body).hexdigest()
        of = least.get(digest) if len(body) >= 100 else None
        want.append((k, len(body), digest, "response" if of is None else "revisit", of))
        least.setdefault(digest, k)
    key = lambda r: tuple(map(str, r))
    assert sorted([(r["key"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows], key=key) == sorted(want, key=key)
    assert len({r["record_id"] for r in rows}) == len(rows)
    assert {r["target_uri"] for r in rows if r["key"] in (2, 3, 4, 5)} == {"unknown:", "http://a.example/x%20y", "http://c.example/%C3%A9%0A"}


def test_no_pages(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    arcs = archive.write_arcs(df, str(tmp_path / "arc"))
    assert arcs.count() == 0
    assert archive.read_warcs(spark, str(tmp_path / "w"), archive.convert(spark, str(tmp_path / "arc"), arcs, str(tmp_path / "w"))).count() == 0


def test_arc_headers():
    text = archive.arc_description(2, "x") + archive.arc_record(2, "dns:a.example", "text/dns", b"1\n2", "20240203040506", "1.2.3.4")
    records = list(archive.read_arc(io.BytesIO(text)))
    assert [(r.place, r.url, r.date, r.content) for r in records[1:]] == [(1, "dns:a.example", "20240203040506", b"1\n2")]
    warc = archive.warc_record("f", records[1], None)
    (header, block), = archive.read_warc(io.BytesIO(warc))
    assert b"WARC-Type: resource" in header and b"WARC-Date: 2024-02-03T04:05:06Z" in header and b"WARC-IP-Address: 1.2.3.4" in header and block == b"1\n2"
    assert b"warcinfo" in archive.warc_record("f", records[0], None)
    for bad in (text[:-3], text[len(archive.arc_description(2, "x")) :], archive.arc_description(2, "x") + archive.arc_record(1, "u", "t/h", b"")):
        with pytest.raises(ValueError):
            list(archive.read_arc(io.BytesIO(bad)))


def test_files_are_closed_in_time(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i, "u", str(i) * 200) for i in range(9)], "page_id long, url string, html string").coalesce(1)
    monkeypatch.setattr(archive, "MOST_RECORDS", 4)
    files = archive.write_arcs(df, str(tmp_path / "arc")).collect()
    assert sorted(r["n"] for r in files) == [1, 4, 4]
    for r in files:
        with gzip.open(tmp_path / "arc" / r["file"]) as file:
            assert len(list(archive.read_arc(file))) == r["n"] + 1


# --- rollups ------------------------------------------------------------------------

CHANGE = "op string, source string, lang string, version string, n_tokens long, old_source string, old_lang string, old_version string, old_n_tokens long"


def test_rollups(spark, tmp_path):
    own = rollup.Rollups(spark, f"file://{tmp_path}/r")

    def totals():
        return {tuple(r)[:3]: tuple(r)[3:] for r in rollup.Rollups(spark, f"file://{tmp_path}/r").totals().collect()}

    def change(*rows):
        return spark.createDataFrame([(*r, *[None] * (9 - len(r))) for r in rows], CHANGE)

    assert totals() == {}
    load = change(("insert", "s", "en", "v1", 10), ("insert", "s", "en", "v1", 10), ("insert", None, "en", "v1", None), ("insert", "t", "de", "v1", 7))
    assert own.commit("load/1", load) and not own.commit("load/1", load)
    assert totals() == {("s", "en", "v1"): (2, 20), (None, "en", "v1"): (1, 0), ("t", "de", "v1"): (1, 7)}
    own.compact()
    assert not own.commit("load/1", load)
    revise = change(("revise", "s", "en", "v2", 12, "s", "en", "v1", 10), ("delete", "t", "de", "v1", 7))
    assert own.commit("later", revise)
    want = {("s", "en", "v1"): (1, 10), ("s", "en", "v2"): (1, 12), (None, "en", "v1"): (1, 0)}
    assert totals() == want
    own._store(rollup.signed(load))  # a table that no commit names, as a lost job leaves it
    own.compact()
    own.compact()
    assert totals() == want and not own.commit("later", revise)
    assert own.commit("none", change().limit(0)) and totals() == want
    with pytest.raises(Exception, match="unknown change"):
        rollup.signed(change(("update", "s", "en", "v1", 1))).collect()


def test_counts(spark):
    from tokenizers import Tokenizer

    from gleanery.llm import tokens

    df = spark.createDataFrame([(0, "a b, c", 5), (1, None, 5)], "doc_id long, text string, n long")
    got = {r["doc_id"]: r["n"] for r in rollup.counted(df, {"n": tokens.BYTE_BPE}).collect()}
    assert got == {0: len(Tokenizer.from_file(tokens.BYTE_BPE).encode("a b, c").ids), 1: 0}


# --- vectors ------------------------------------------------------------------------


def nearest(ids, x, q, k):
    scores = [(-float(x[i] @ x[q]), int(ids[i])) for i in range(len(ids)) if ids[i] != ids[q]]
    return [v for _, v in sorted(scores)[:k]]


def frame(spark, ids, x):
    return spark.createDataFrame(list(zip(map(int, ids), x.tolist(), strict=True)), "vec_id long, embedding array<float>")


@pytest.mark.parametrize("block", [4096, 50])
def test_recall_and_ties(spark, monkeypatch, block):
    """Random vectors of unlike norms, a vector that a third of all rows share, and small blocks."""
    monkeypatch.setattr(vectors, "BLOCK", block)
    random = np.random.default_rng(3)
    x = (random.normal(size=(600, 16)) * random.uniform(0.5, 1.5, (600, 1))).astype(np.float32).astype(np.float64)
    x[::3] = x[0]
    ids = random.permutation(600)
    rows = vectors.search(frame(spark, ids, x).repartition(3), F.col("vec_id") % 20 == 0).collect()
    found, hits = {}, 0
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    where = {int(v): i for i, v in enumerate(ids)}
    for q in range(0, 600, 20):
        got = found[q]
        assert len(got) == 20 and len({v for v, _ in got}) == 20 and all(v != q for v, _ in got)
        assert all(s == pytest.approx(float(x[where[v]] @ x[where[q]]), abs=1e-12) for v, s in got)
        assert got == sorted(got, key=lambda g: (-g[1], g[0]))
        hits += len({v for v, _ in got} & set(nearest(ids, x, where[q], 20)))
    assert hits / 600 >= 0.9


def test_queries_meet_entries_in_blocks(spark, monkeypatch):
    """However many queries visit a slice, a task sees a block of them at a time, and the results stay."""
    x = np.random.default_rng(4).normal(size=(600, 16)).astype(np.float32).astype(np.float64)
    df = frame(spark, range(600), x)
    want = sorted(map(tuple, vectors.search(df, F.col("vec_id") % 5 == 0).collect()))
    rank = vectors._rank

    def bounded(k, tables):
        run = rank(k, tables)

        def checked(asked, held):
            assert asked.num_rows <= 40, asked.num_rows
            return run(asked, held)

        return checked

    monkeypatch.setattr(vectors, "_rank", bounded)
    monkeypatch.setattr(vectors, "QUERIES", 20, raising=False)
    got = sorted(map(tuple, vectors.search(df, F.col("vec_id") % 5 == 0).collect()))
    assert [g[:3] for g in got] == [w[:3] for w in want] and len(want) == 120 * 20


def test_unusable_and_few_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.0, 1.0]), (40, None), (60, []), (80, [0.0, 0.0]), (100, [nan, 1.0]), (120, [inf, 1.0]), (140, [None, 1.0]), (160, [1.0]), (None, [1.0, 1.0]), (3, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = sorted(tuple(r) for r in vectors.search(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 20, 0.5), (0, 2, 3, 0.0), (20, 1, 0, 0.5), (20, 2, 3, 0.5)]
    assert vectors.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert vectors.search(df.filter("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


# --- the pipeline ---------------------------------------------------------------------


def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns, rows = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        path = f"{tmp_path}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        rows[name] = out.collect()
        kept = {r["doc_id"]: r for r in rows[name]}
        if name == "quality_rules":
            assert set(kept) == {r["doc_id"] for r in quality.judge(docs, labels).filter("kept").collect()}
        elif name == "language_id":
            found = {r["doc_id"]: r for r in language.identify(docs).collect()}
            assert set(kept) == {k for k, r in found.items() if r["lang_pred"] != "und" and r["score"] >= 0.5}
        elif name == "near_duplicates":
            assert set(kept) == set(kept_by_brute_force([(k, r["text"]) for k, r in before.items()])) and len(rows[name]) == len(kept)
        elif name == "private_data":
            assert set(kept) == set(before)
            for k, r in kept.items():
                left = pii.detect(before[k]["text"])
                assert (r["text"] == before[k]["text"]) == (not left) and r["n_chars"] == len(r["text"])
                assert all(before[k]["text"][a:b] not in r["text"] for a, b, kind, _ in left)
        if name != "packing":
            assert out.columns == columns
            if name != "private_data":
                assert all(kept[k] == before[k] for k in kept)
            docs = out
    assert {r["doc_id"] for r in rows["packing"]} == {r["doc_id"] for r in docs.collect()}
    assert packing.padded(spark.createDataFrame(rows["packing"])).filter("n_ids > 2048").count() == 0


def test_columns_of_users_stay(spark, tmp_path):
    """Every name that a stage uses itself, as a column of the documents."""
    names = ["score", "held_out", "lang_pred", "spans", "_n", "_node", "_bands", "n_entities", "_file", "_row", "kept", "root", "n_words", "_own_3", "key", "node", "SCORE"]
    names = [n for n in names if n != "SCORE"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60")
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(i) + F.col("doc_id"))
    for name, stage in corpus_pipeline.STAGES[:4]:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        assert out.columns == docs.columns and out.count() > 0
        assert all(r[n] == i + r["doc_id"] for r in out.collect() for i, n in enumerate(names)), name
        docs = out


def test_a_batch_committed_while_folding_counts_once(spark, tmp_path, monkeypatch):
    own = rollup.Rollups(spark, f"file://{tmp_path}/r")
    change = spark.createDataFrame([("insert", "s", "en", "v", 5)], "op string, source string, lang string, version string, n_tokens long")
    own.commit("one", change)
    store = own._store

    def meanwhile(totals):
        monkeypatch.setattr(own, "_store", store)
        own.commit("two", change)
        return store(totals)

    monkeypatch.setattr(own, "_store", meanwhile)
    own.compact()
    assert [tuple(r)[3:] for r in own.totals().collect()] == [(2, 10)]
    own.compact()
    assert [tuple(r)[3:] for r in own.totals().collect()] == [(2, 10)] and not own.commit("two", change)


def test_stages_take_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0
