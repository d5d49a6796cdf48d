"""SimHash components, packing, WARC fixity, URL templates, HTML extraction and
the pipeline on small inputs."""

import os
import random
import sys
import zlib

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ledgerlake.llm import (html_extract, packing, queries, simhash, url_filter, warc_fixity)
from ledgerlake.llm.graph import connected_components

SF = "/root/testdata/sf0.001"
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))


# --- SimHash -----------------------------------------------------------------------

def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(values, max_bits):
    parent = list(range(len(values)))
    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprints(spark):
    texts = ["A b\tC d e", "a B c d e", "one", "", None, "É x y z É", "w " * 9000]
    for t in texts:
        assert simhash.fingerprint(t) == plain_fingerprint(t)
    # the hash is that of Spark's own function
    h = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] % (1 << 64)
    assert h == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_buckets_against_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    x = np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 12, dtype=np.uint64))
                                 for _ in range(20)] + [rng.integers(0, 1 << 63, 200, dtype=np.uint64)])
    x = np.unique(x)
    x = x[np.argsort(simhash.gray_rank(x))]
    for bits in (0, 1, 2, 4):
        got = simhash.link_bucket(x, bits).root
        want = roots([int(v) for v in x], bits)
        assert len(set(zip(got.tolist(), want))) == len(set(want)) == len(set(got.tolist()))


def test_links_reach_all_components(spark):
    rng = random.Random(2)
    values = [rng.getrandbits(64) for _ in range(40)]
    values += [v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for v in values for _ in range(4)]
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    want = roots([v % (1 << 64) for v in values], 4)
    groups = {frozenset(i for i, r in enumerate(want) if r == q) for q in set(want)}
    for chunk in (20_000, 3):                        # hot buckets are cut in chunks
        found = connected_components(simhash.links(df, 4, chunk=chunk))
        by = {r.node: r.root for r in found.collect()}
        got = {}
        for i, v in enumerate(values):
            got.setdefault(by.get(v, v), set()).add(i)
        assert {frozenset(g) for g in got.values()} == groups


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (7, 3)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(61)}
    assert connected_components(edges.limit(0)).count() == 0


def test_near_duplicates(spark):
    say = lambda k, n: " ".join(f"{k}{i * 7919 % 997}" for i in range(n))
    texts = [say("a", 300), say("b", 300), say("a", 300), say("a", 300).upper(), None, "", say("a", 299)]
    rows = [(i + 10, t, "x", "y") for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id long, text string, fp string, root string")
    got = {r.doc_id: r for r in simhash.components(d).collect()}
    fps = [plain_fingerprint(t) for t in texts]
    want = roots(fps, 4)
    assert [got[i + 10].component_id for i in range(7)] == [10 + r for r in want]
    assert [got[i + 10].fp % (1 << 64) for i in range(7)] == fps
    kept = simhash.deduplicate(d.unionByName(d.limit(2)))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({10 + r for r in want}) and kept.columns == d.columns
    assert simhash.deduplicate(d.limit(0)).count() == 0
    nameless = d.withColumn("doc_id", F.lit(None).cast("long"))
    assert simhash.deduplicate(nameless).count() == 7


def test_texts_that_share_an_id_stay(spark):
    say = lambda k: " ".join(f"{k}{i * 7919 % 997}" for i in range(300))
    rows = [(3, say("a")), (5, say("a")), (5, say("b")), (5, say("b")), (6, say("c")), (None, say("c"))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text) for r in simhash.deduplicate(d).collect())
    assert got == [(0, say("c")), (3, say("a")), (5, say("b")), (6, say("c"))]


# --- packing ------------------------------------------------------------------------

def test_first_fit_decreasing_is_the_plain_one():
    rng = random.Random(4)
    for _ in range(30):
        lengths = [rng.randint(1, 50) for _ in range(rng.randint(0, 60))]
        room, free, want = 50, [], {}
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            b = next((k for k, f in enumerate(free) if f >= lengths[i]), len(free))
            if b == len(free):
                free.append(room)
            free[b] -= lengths[i]
            want[i] = b
        assert dict(enumerate(packing.first_fit_decreasing(lengths, room))) == want


def test_packing_holds_every_token_once(spark):
    from tokenizers import Tokenizer
    how = queries.packing_defaults()
    tok = Tokenizer.from_file(how.tokenizer)
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["Hello", "naïve", "don't", "x1y2", "<|endoftext|>", "  ", "日本語", "a\tb"])
                      for _ in range(rng.choice([1, 5, 300, 5000]))) for _ in range(25)] + [None, "", "\n\n"]
    d = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, offset int")
    from dataclasses import replace
    small = replace(how, group_chars=20_000)
    got = packing.pack(d, small).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, t in enumerate(texts):
        want = tok.encode(t or "", add_special_tokens=False).ids + [2]
        parts = sorted(by_doc[i], key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in parts) == np.array(want, "<u4").tobytes()
        assert [r.start for r in parts] == np.cumsum([0] + [r.length for r in parts])[:-1].tolist()
        assert {r.doc_tokens for r in parts} == {len(want)}
    padding = tokens = 0
    for rows in by_seq.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == np.cumsum([0] + [r.length for r in rows])[:-1].tolist()
        used = sum(r.length for r in rows)
        assert 0 < used <= 4096
        tokens, padding = tokens + used, padding + (0 if used & (used - 1) == 0 else 4096 - used)
    assert padding < 0.01 * tokens
    digest = packing.with_digest(packing.pack(d, small)).collect()
    assert {(r.doc_id, r.start, r.ids_crc32) for r in digest} == {
        (r.doc_id, r.start, zlib.crc32(bytes(r.ids))) for r in got}
    assert packing.pack(d.limit(0), small).count() == 0


# --- WARC fixity ----------------------------------------------------------------------

def test_audit_finds_each_fault(spark):
    rows = [("f", i * 100, f"record {i}") for i in range(5000)] + [("g", 0, None), ("g", 50, "")]
    a = spark.createDataFrame(rows, "file string, offset long, payload string")
    how = warc_fixity.Tree(range_bytes=1000, fanout=4)
    assert warc_fixity.audit(a, a, how).count() == 0
    b = (a.where("offset <> 700").withColumn("payload", F.when(F.col("offset") == 123400, "other").otherwise(F.col("payload")))
         .unionByName(spark.createDataFrame([("f", 900_000, "more"), (None, 1, "no place")], a.schema)))
    got = {tuple(r) for r in warc_fixity.audit(a, b, how).collect()}
    assert got == {("f", 700, "missing"), ("f", 123400, "changed"), ("f", 900_000, "extra")}
    twice = a.unionByName(a.where("offset = 200"))
    assert {tuple(r) for r in warc_fixity.audit(a, twice, how).collect()} == {("f", 200, "changed")}
    assert warc_fixity.audit(a.limit(0), a.limit(0), how).count() == 0
    assert warc_fixity.audit(a, a.limit(0), how).count() == len(rows)


def test_the_replica_is_hashed_and_records_without_id_have_a_place(spark, tmp_path, monkeypatch):
    rows = [(i if i % 4 else None, f"http://h/{i}", f"<p>{i}</p>") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    seen = []
    real = warc_fixity.audit
    monkeypatch.setattr(warc_fixity, "audit", lambda a, b, *x: seen.append((a, b)) or real(a, b, *x))
    got = {(r.page_id, r.status) for r in queries.op7_warc_fixity(spark, str(tmp_path)).collect()}
    assert got == {(i, "missing" if i % 89 == 7 else "changed") for i in range(200)
                   if i % 4 and (i % 89 == 7 or i % 97 == 5)}
    first, second = seen[0]
    assert first.where("file is null").count() == 0 and second.where("page_id is null").count() == 50
    assert second.where("replica is null or digest <> replica").count() == 0


# --- URL filters ------------------------------------------------------------------------

def test_hosts_paths_and_rules(spark):
    urls = ["http://Www.Example.ORG/es/1", "https://example.org/en/12?x=/y", "http://a.com/fr/x", "a.com/de/", None,
            "http://b.com", "ftp://h.net#/p/q", "http://x.example.org/en/2", "http://badorg/x", "://ÄB.org/z?"]
    d = spark.createDataFrame([(i, u, 0, "t") for i, u in enumerate(urls)], "page_id long, url string, bad int, template string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
           for r in url_filter.judge(d, "page_id", queries.URL_RULES).collect()}
    assert got[0] == ("www.example.org", "/es/1", "example.org/es/", "block")
    assert got[1] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[2] == ("a.com", "/fr/x", "com/fr/", "allow") and got[3][:3] == ("", "", None)
    assert got[4][:3] == ("", "", None) and got[5][:3] == ("b.com", "", None)
    assert got[6][:3] == ("h.net", "", None) and got[7][2] == "org/" and got[8][2] is None
    assert got[9][:3] == ("Äb.org", "/z", "org/")
    assert url_filter.judge(d.limit(0), "page_id", {}).count() == 0


def test_templates_by_purity(spark):
    rows = [(i, f"http://h.net/{kind}/{i}.html", int(kind == "spam" and i % 10 > 0)) for i in range(200)
            for kind in ("news", "spam")]
    rows += [(1000 + i, f"http://h.net/tag/{chr(97 + i % 26)}{chr(97 + i // 26)}", 0) for i in range(200)]
    rows += [(5000, "http://h.net/spam/77777.html", None), (5001, "http://h.net/" + "a/" * 400, None)]
    d = spark.createDataFrame(rows, "page_id long, url string, bad int")
    got = {r.page_id: r for r in url_filter.judge(d.unionByName(d.where("page_id = 5000")), "page_id", {}).collect()}
    assert got[5000].verdict == "block" and got[5000].template == "/spam/*"
    assert got[1003].verdict == "allow" and got[1003].template == "/tag/*" and got[5001].verdict == "allow"


def test_a_bad_section_of_a_wide_host(spark):
    name = lambda i: chr(97 + i % 26) + chr(97 + i // 26)
    for sections in (64, 65, 200):
        rows = [(1000 * s + i, f"http://h.net/{name(s)}/{i}.html", int(s == 7))
                for s in range(sections) for i in range(200 if s == 7 else 20)]
        rows += [(-1, f"http://h.net/{name(7)}/999999.html", None)]
        d = spark.createDataFrame(rows, "page_id long, url string, bad int")
        got = {r.page_id: r for r in url_filter.judge(d, "page_id", {}).collect()}
        assert all(got[r[0]].verdict == ("allow" if r[2] == 0 else "block") for r in rows), sections
        assert got[-1].template.startswith(f"/{name(7)}/") and got[8000].template.startswith("/*/")


# --- HTML extraction --------------------------------------------------------------------

def test_blocks():
    html = ("<html><title>t</title><body><p>a&amp;b <b>c</b>d<br>e<p>f<script>var x='</p>';</script>g"
            "<!-- <p>no --><ul><li>h<li>i</ul><a title='1>0' href=x>j</a>\n\n k</body>")
    assert [b.text for b in html_extract.blocks(html)] == ["a&b cd e", "f", "g", "h", "i", "j k"]
    assert html_extract.blocks("") == [] and [b.text for b in html_extract.blocks("plain &lt;")] == ["plain <"]


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    net = html_extract.BiLstm(3, 1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.normal(size=(4, 2, html_extract.INPUT))
    mask = np.array([[1, 1], [1, 1], [1, 0], [1, 0]], float)
    y = rng.integers(0, 2, (4, 2)).astype(float)
    def loss():
        z = net.logits(x, mask)
        return float(((np.log1p(np.exp(z)) - y * z) * mask).sum() / mask.sum())
    g = net.gradients(x, mask, y)
    for k, v in net.p.items():
        at = tuple(rng.integers(0, n) for n in v.shape)
        old, step = v[at], 1e-5
        v[at] = old + step
        up = loss()
        v[at] = old - step
        down = loss()
        v[at] = old
        assert abs((up - down) / (2 * step) - g[k][at]) < 2e-4, k


def test_held_out_pages(spark):
    pages = queries.table(spark, "/root/testdata/sf0.01", "pages").select("page_id", "url", "html", F.lit(1).alias("text"))
    odd = spark.createDataFrame([(-1, None, None, 1), (-2, "u", "", 1), (-3, "u", "<nav>x</nav>", 1)], pages.schema)
    got = {r.page_id: r for r in html_extract.extract(
        pages.unionByName(odd), how=html_extract.Labeller(sample_pages=60, epochs=8)).collect()}
    assert got[-1].text == got[-2].text == "" and got[-1].n_chars == 0
    right = 0
    rows = pages.collect()
    for r in rows:
        want = " ".join(b.text for b in html_extract.blocks(r.html) if html_extract.weak_label(b))
        right += got[r.page_id].text == want and got[r.page_id].n_chars == len(want)
    assert right >= 0.98 * len(rows)
    assert html_extract.extract(pages.limit(0)).count() == 0


# --- queries and pipeline -------------------------------------------------------------------

def test_queries_against_their_sql(spark):
    import __spark_entry__ as E
    from ledgerlake.llm import oracle
    from oracle_check import compare
    assert set(queries.queries()) <= set(E.queries()) and "pipeline" in E.queries()
    for name in oracle.oracle_queries():
        r = compare(spark, SF, [name], verbose=False)[name]
        assert "error" not in r and r["cols_match"] and r["values_match"] and not r["type_mismatches"], r


def test_pipeline_stages(spark):
    """Each stage keeps the columns, whatever they are called, and the ids."""
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]
    docs = queries.table(spark, SF, "documents").where("doc_id < 60").withColumns(
        {c: F.lit(1) for c in ("_id", "_key", "k", "fp", "_text", "h")})
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, given, SF), name)
        if name != "packing":
            assert out.columns == docs.columns and 0 < out.count() <= given.count()
            assert out.count() == out.select("doc_id").distinct().count()
            given = out
    assert set(r.doc_id for r in out.select("doc_id").distinct().collect()) == {r.doc_id for r in given.collect()}
