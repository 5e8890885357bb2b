"""Neighbours and near copies of embeddings, and archives of pages."""
import hashlib

import numpy as np
import pytest

from conftest import SF_DIR
from ledgerline.llm import ann, catalog, embed_dedup, secrets, simhash, warc
from oracle import compare, connect


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int").repartition(3)


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    for k in range(5):
        x[k * 100:(k + 1) * 100] = x[k * 100] + rng.normal(scale=0.05, size=(100, 16))
    x[900:1000] = x[900]
    return x


def unit(x):
    x = x.astype(float)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


ODD = [(10_000, None, 0), (10_050, [0.0] * 16, 0), (10_100, [float("nan")] * 16, 0), (10_150, [None] * 16, 0), (None, [1.0] * 16, 0), (10_200, [], 0)]


def test_neighbours(spark, clustered):
    rows = [(i, v.tolist(), 1) for i, v in enumerate(clustered)]
    got = ann.search(vectors(spark, rows + ODD), rows_per_part=100).collect()
    s = unit(clustered) @ unit(clustered).T
    hits = 0
    for q in range(0, 1500, 50):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        assert all(abs(r.score - s[q, r.vec_id]) < 1e-9 and r.vec_id != q for r in mine)
        want = sorted(s[q][np.arange(1500) != q])[-5:]
        hits += sum(r.score >= want[0] - 1e-9 for r in mine)
    assert hits / 150 >= 0.9 and len(got) == 150
    # Copies: ties go to the smaller ids.
    assert [r.vec_id for r in got if r.query_id == 950] == [900, 901, 902, 903, 904]


def test_few_candidates(spark):
    got = ann.search(vectors(spark, [(0, [1.0, 0.0], 0), (7, [0.0, 1.0], 0), (50, [1.0, 1.0], 0)] + ODD)).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 50), (0, 2, 7), (50, 1, 0), (50, 2, 7)]
    assert ann.search(vectors(spark, ODD)).count() == 0 and ann.search(vectors(spark, [])).count() == 0


def test_near_copies(spark, clustered):
    rows = [(i, v.tolist(), 1) for i, v in enumerate(clustered)]
    got = {r.vec_id: r for r in embed_dedup.near_copies(vectors(spark, rows + ODD)).collect()}
    near = unit(clustered) @ unit(clustered).T >= 0.95
    assert len(got) == 1500 + len(ODD)
    assert sum(got[i].n_links for i in range(1500)) >= 0.99 * (near.sum() - 1500)
    assert all(got[i].n_links <= near[i].sum() - 1 for i in range(1500))
    assert all(got[i].component_id == 900 and got[i].kept == (i == 900) for i in range(900, 1000))
    for v, _, _ in ODD:
        assert got[v].n_links == 0 and got[v].component_id == v
    assert embed_dedup.near_copies(vectors(spark, [])).count() == 0


def test_window_links_are_a_forest_of_all_near_pairs():
    """Against every pair of the window one by one, with values at the bound; sorted rows of any number."""
    rng = np.random.default_rng(9)
    for count, window in ((0, 4), (1, 4), (2, 4), (700, 1), (700, 40), (1300, 700)):
        x = rng.normal(size=(max(1, count // 6), 8))[rng.integers(0, max(1, count // 6), count)] if count else np.zeros((0, 8))
        x = x + rng.normal(scale=0.12, size=x.shape)
        pairs = [(i, j) for i in range(count) for j in range(i + 1, min(count, i + window + 1))]
        i, j = np.array(pairs or [(0, 0)][:0], dtype=int).reshape(-1, 2).T
        values = ann.cosine(x[i], x[j])
        # The bound is a value that occurs, so that pair links and the next smaller one doesn't.
        least = float(np.sort(values)[-max(1, len(values) // 30)]) if len(values) else 0.95
        near = values >= least
        nodes = np.arange(count) * 3 + 5
        got = embed_dedup._window_links(nodes, x, window, least, rows=64)
        want, found = np.arange(count), np.arange(count)
        embed_dedup._join(want, i[near], j[near])
        a, b = (got - 5) // 3
        assert set(zip(a.tolist(), b.tolist())) <= set(zip(i[near].tolist(), j[near].tolist()))
        embed_dedup._join(found, a, b)
        assert (want == found).all() and got.shape[1] == count - len(set(found.tolist()))


def test_probes_list_a_bounded_number_of_links(spark, clustered):
    """Few listed links give the same classes."""
    rows = vectors(spark, [(i, v.tolist(), 1) for i, v in enumerate(clustered)])
    few = embed_dedup.near_copies(rows, per_probe=2).select("vec_id", "component_id").collect()
    assert sorted(few) == sorted(embed_dedup.near_copies(rows).select("vec_id", "component_id").collect())


def test_near_copies_in_a_dense_direction(spark):
    """A third of the rows lies around one direction; pairs of copies among them are found like any others."""
    rng = np.random.default_rng(3)
    x = unit(rng.normal(size=(20_000, 64)))
    x[:6000] = unit(x[0] + unit(rng.normal(size=(6000, 64))) * 0.484)
    x[6000:6600] = unit(x[:600] + unit(rng.normal(size=(600, 64))) * 0.3)
    got = {r.vec_id: r.component_id for r in embed_dedup.near_copies(
        vectors(spark, [(i, v.tolist(), 1) for i, v in enumerate(x)])).select("vec_id", "component_id").collect()}
    a, b = np.nonzero(np.triu(x[:6600] @ x[:6600].T >= 0.95 + 1e-6, 1))
    joined = np.mean([got[i] == got[j] for i, j in zip(a.tolist(), b.tolist())])
    assert len(a) >= 300 and joined >= 0.98, (len(a), joined)


def page_rows():
    long, other = "x" * 1200, "é" * 700
    return [(1, "http://a", long), (2, "http://b\r\nc", long), (3, None, long), (3, None, long), (4, "u", "short"), (5, "u", "short"),
            (6, "u", None), (7, "u", ""), (8, "u", other), (None, "u", other), (9, "u", other)]


def test_archives(spark):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string").repartition(2)
    records = warc.read_archives(warc.write_archives(warc.mark_revisits(pages), archive_bytes=2000)).collect()
    assert len(records) == len(page_rows()) and all(r.error is None for r in records)
    for r in records:
        html = next((h or "").encode() for p, _, h in page_rows() if p == r.page_id)
        assert (r.payload_bytes, r.payload_digest) == (len(html), hashlib.sha1(html).hexdigest())
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in records) == [
        (0, "response", None), (1, "revisit", 3), (2, "revisit", 3), (3, "response", None), (3, "response", None), (4, "response", None),
        (5, "response", None), (6, "response", None), (7, "response", None), (8, "revisit", 9), (9, "response", None)]
    assert warc.read_archives(warc.write_archives(warc.mark_revisits(pages.limit(0)))).count() == 0


def test_broken_archives():
    records = [warc.make_record(k, "u", b"<p>" + bytes([65 + k % 20]) * 500 + b"%d" % k, hashlib.sha1(
        b"<p>" + bytes([65 + k % 20]) * 500 + b"%d" % k).hexdigest(), None) for k in range(300)]
    archive = warc.pack(records)
    assert archive[:4] == (0x184D2A5D).to_bytes(4, "little")
    good = list(warc.unpack(archive))
    assert len(good) == 300 and all(e is None for _, _, e in good)
    cut = list(warc.unpack(archive[:-10]))
    assert len(cut) == 300 and cut[-1][2] and all(e is None for _, _, e in cut[:-1])
    at = good[10][0]
    hurt = bytearray(archive)
    hurt[good[11][0] - 2] ^= 255                      # the checksum of record 10
    assert [o for o, _, e in warc.unpack(bytes(hurt)) if e] == [at]
    for wrong in (records[0].replace(b"WARC/1.1", b"HTTP/1.1"), records[0][:-1], records[0].replace(b"<p>", b"<q>"),
                  records[0].replace(b"WARC-Type", b"WARC-Tipe")):
        with pytest.raises(warc.BadArchive):
            warc.parse_record(wrong)


def test_files_read_back(spark, tmp_path):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string")
    for row in warc.write_archives(warc.mark_revisits(pages)).collect():
        (tmp_path / row.archive).write_bytes(row.content)
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert warc.read_archives(files, "path", "content").count() == len(page_rows())


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    con, fn = connect(SF_DIR), catalog.QUERIES[name]
    import oracle
    unwanted, oracle.UNWANTED = oracle.UNWANTED, ("CartesianProduct", "BroadcastNestedLoopJoin")
    try:
        assert compare(spark, con, fn, catalog.ORACLES[name], SF_DIR)[1] is None
    finally:
        oracle.UNWANTED = unwanted


def test_pages_with_other_columns(spark):
    from pyspark.sql import functions as F
    wide = spark.createDataFrame(page_rows(), "page_id long, url string, html string").withColumns(
        {"payload": F.lit(1), "digest": F.lit("x"), "owner": F.lit(2), "n": F.lit(3), "same": F.lit("s"), "refers_to": F.lit("r")})
    plain = wide.select("page_id", "url", "html")

    def content(df):
        return sorted(((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(
            warc.write_archives(warc.mark_revisits(df))).collect()), key=str)
    assert content(wide) == content(plain) and content(wide.limit(0)) == []


def test_pipeline(spark):
    """The whole run gives what its stages give one after the other, and each stage's decision shows in its result."""
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "secret_scan", "mix_sources", "byte_bpe"]
    steps, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF_DIR).cache()
        assert name == "byte_bpe" or now.columns == docs.columns, name
        steps[name] = now
    ids = {name: {r[0] for r in df.select("doc_id").collect()} for name, df in steps.items()}
    assert ids["byte_bpe"] == ids["mix_sources"] <= ids["secret_scan"] == ids["simhash_dedup"] <= ids["language_id"]
    assert ids["simhash_dedup"] == {r.component_id for r in simhash.simhash_groups(steps["language_id"]).collect()}
    hit = {r.doc_id for r in secrets.scan_secrets(steps["simhash_dedup"]).collect() if r.spans}
    assert {r.doc_id for r in steps["secret_scan"].where("text LIKE '%[SECRET]%'").collect()} == hit
    out = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, out.drop("ids").collect())) == sorted(map(tuple, steps["byte_bpe"].drop("ids").collect()))
    for df in (docs, *steps.values()):
        df.unpersist()
