"""Every operator against a brute-force version, and on odd and empty tables."""

import collections
import hashlib
import html
import re
import time
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from plaintscope.llm import encoding, host_paths, line_rules, ngram_join, packing, product_quantiser
from plaintscope.llm import queries as Q
from plaintscope.llm import suffix_family, token_files, toxicity, url_intervals, viterbi_pieces
from llm_tables import odd_docs, small_docs  # noqa: F401

SF = "/root/testdata/sf0.001"


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def ids_of(rows):
    t = Tokenizer.from_file(encoding.default_path())
    return {d: np.array(t.encode(x or "", add_special_tokens=False).ids, dtype="<u4") for d, x in rows}


def test_piece_encoder_equals_the_library():
    e = encoding.PieceEncoder(encoding.default_path())
    cases = ["", "a", " a", "a  b", "don't say 'it's'", "x\n\n y\t z ", "½ a½ b² <|endoftext|> q", "日本語 テキスト",
             "\x1c a\x1cb \x85 c", "a  b 　c", "a\0b c\0 d", "2abc 3.4,5 --x", "w" * 5000, "tail, tail. tail!?",
             "<|endoftext|>", "<|endoftext|>a b", "a b<|endoftext|>", "a<|endoftext|>b c", "a <|endoftext|> b  c",
             "x <|endoftext|><|endoftext|> y", " <|endoftext|>\n", "a <|endoftext| b", "<|ENDOFTEXT|>",
             "1\n2 b-c\n", "q\u3000z \x85 v-1 2.5", "Ġ ĠĠ Ġa Ġ1", "x-1 y_2 z/3 $$$ a\n\nb", "x-1  y_2"]
    want = ids_of(enumerate(cases))
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode_many(cases)] == [want[i].tolist() for i in range(len(cases))]


@pytest.mark.parametrize("which", ["odd_docs", "small_docs"])
def test_token_files_round_trip(request, which):
    docs = request.getfixturevalue(which)
    want = ids_of(texts(docs))
    manifest = token_files.write_token_files(docs, sequence_length=64)
    got = sorted(token_files.read_documents(manifest).collect(), key=lambda r: r["doc_id"])
    at = 0
    for r in got:
        ids = np.append(want[r["doc_id"]], np.uint32(2)).astype("<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    part = manifest.orderBy("part").first()
    ids, mask = token_files.read_sequence(part["folder"], part["file"], 0)
    assert len(ids) == 64 and mask[0]


@pytest.mark.parametrize("which", ["odd_docs", "small_docs"])
def test_packing_places_every_id_once(request, which):
    docs = request.getfixturevalue(which)
    want = ids_of(texts(docs))
    rows = packing.pack_pieces(docs).collect()
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(want)
    for d, rs in by_doc.items():
        ids, at = np.append(want[d], np.uint32(0)).astype("<u4"), 0
        for r in sorted(rs, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    if which == "small_docs":
        assert sum(r["length"] for r in rows) >= 0.97 * 1024 * len(by_seq)


def brute_repeats(rows):
    seen, out = set(), {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in [p for p in range(len(b) - 99) if b[p:p + 100] in seen or seen.add(b[p:p + 100])]:
            gone[p:p + 100] = b"\1" * 100
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("which,batches", [("odd_docs", 1), ("odd_docs", 3), ("small_docs", 4), ("small_docs", 7)])
def test_repeats_equal_brute_force(request, which, batches):
    docs = request.getfixturevalue(which)
    got = suffix_family.remove_repeats(docs, n_batches=batches)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got.collect()}
    assert got == brute_repeats(sorted(texts(docs)))


def test_repeats_of_rows_without_or_with_one_id(spark):
    t = "a passage that is certainly longer than one hundred bytes, " * 4
    docs = spark.createDataFrame([(None, t), (5, t), (5, t)], "doc_id long, text string")
    rows = suffix_family.remove_repeats(docs, with_text=True).collect()
    assert sorted(len(r["text"]) > 50 for r in rows) == [False, False, True]
    assert [r["doc_id"] for r in rows if r["text"]] == [None]


def test_family_levels_merge_like_a_counter(spark, small_docs):
    from pyspark.sql import functions as F
    family = suffix_family.SuffixIndexFamily(spark, shards=3)
    sizes = []
    for i in range(5):
        family.add(small_docs.where(F.col("doc_id") % 5 == i).select(F.col("doc_id").alias("doc"), "text"))
        sizes.append(sorted(n for n, _ in family.levels))
    assert sizes == [[1], [2], [1, 2], [4], [1, 4]]


def test_long_text_stretches_give_the_same_runs():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 60_000).astype(np.uint8)
    whole = suffix_family.text_runs(data, np.array([0, len(data)]))
    size, suffix_family.GROUP_BYTES = suffix_family.GROUP_BYTES, 3_000
    try:
        cut = suffix_family._long_text_runs(data)
    finally:
        suffix_family.GROUP_BYTES = size
    assert set(zip(whole["p"], whole["key"], whole["run"])) == set(zip(cut["p"], cut["key"], cut["run"]))


def shingle_set(t):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_groups(rows):
    sets = {d: shingle_set(t) for d, t in rows}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    order = sorted(sets)
    for i, a in enumerate(order):
        for b in order[:i]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


@pytest.fixture(scope="module")
def near_copies(spark):
    """A hub with copies at many distances, chains, and texts that share a passage only."""
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    base = [word() for _ in range(120)]
    rows = [(1000, " ".join(base))]
    for i in range(60):
        w = list(base)
        for at in rng.choice(len(w), rng.integers(1, 9), replace=False):
            w[at] = word()
        rows.append((i, " ".join(w)))
    chain = list(base)
    for i in range(30):
        chain = [word(), *chain[:-1]] if i % 2 else chain[3:] + [word() for _ in range(3)]
        rows.append((200 + i, " ".join(chain)))
    rows += [(300 + i, " ".join(base[:40] + [word() for _ in range(rng.integers(5, 60))])) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("which", ["odd_docs", "small_docs", "near_copies"])
def test_jaccard_groups_equal_brute_force(request, which):
    docs = request.getfixturevalue(which)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs).collect()}
    assert got == brute_groups(texts(docs))


def test_jaccard_block_comparison_is_used(near_copies, monkeypatch):
    monkeypatch.setattr(ngram_join, "SALT_MEMBERS", 7)
    monkeypatch.setattr(ngram_join, "BLOCK", 5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(near_copies).collect()}
    assert got == brute_groups(texts(near_copies))


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(product_quantiser, "PER_LIST", 40)
    monkeypatch.setattr(product_quantiser, "BLOCK", 16)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 16))
    x = np.concatenate([x, x[:60] + rng.normal(size=(60, 16)) * 0.1, x[:20], x[:1] + rng.normal(size=(50, 16)) * 0.05])
    x = x.astype(np.float32)
    rows = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(x)]
    odd = [(9001, None, 1), (9002, [0.0] * 16, 1), (9003, [float("nan")] * 16, 1), (9004, x[0].tolist(), None), (9005, [], 1),
           (9006, [None] * 16, 0), (9007, [1.0, 2.0], 1), (None, x[0].tolist(), 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in product_quantiser.near_vectors(df).collect()}
    n, up = collections.Counter(), list(range(len(x)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(x)):
        for j in range(len(x)):
            a, b = x[i].astype(float), x[j].astype(float)
            if i != j and i % 2 == j % 2 and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                n[i] += 1
                up[max(root(i), root(j))] = min(root(i), root(j))
    assert max(n.values()) > 20
    assert {i: (got[i]["n_links"], got[i]["component_id"]) for i in range(len(x))} == {i: (n[i], root(i)) for i in range(len(x))}
    assert all(got[i]["n_links"] == 0 for i in range(9001, 9008))
    assert got[None]["component_id"] is None and not got[None]["kept"]
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values() if r["vec_id"] is not None)


def test_tiny_and_huge_vectors_link_by_direction(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=8)
    rows = [(i, (x + rng.normal(size=8) * 0.01).tolist(), 1) for i in range(20)]
    rows += [(20, (x * 1e-200).tolist(), 1), (21, (x * 1e200).tolist(), 1), (22, (x * 1e-310).tolist(), 1), (23, (-x * 1e-200).tolist(), 1)]
    docs = spark.createDataFrame([(*r, "a", 1) for r in rows] * 2, "vec_id long, embedding array<double>, label int, id string, copies int")
    got = {r["vec_id"]: r for r in product_quantiser.near_vectors(docs).collect()}
    assert all(got[i]["n_links"] == 45 and got[i]["component_id"] == 0 for i in range(23)) and got[23]["n_links"] == 1


@pytest.mark.parametrize("d", [64, 256])
def test_probes_miss_no_link_of_low_rank_vectors(d):
    rng = np.random.default_rng(7)
    basis = rng.normal(size=(4, d))
    x = rng.normal(size=(1500, 4))
    x = np.concatenate([x, x + rng.normal(size=x.shape) * 0.08]) @ basis
    x /= np.linalg.norm(x, axis=1)[:, None]
    book = product_quantiser.Codebook(x, 60)
    cell, probes = book.encode(x)[0], book.probes(x, np.sqrt(2 - 2 * product_quantiser.THRESHOLD))
    i, j = np.nonzero(x @ x.T >= product_quantiser.THRESHOLD)
    asked = np.zeros((len(x), 60), dtype=bool)
    for row, p in zip(asked, probes):
        row[p] = True
    assert len(i) > len(x) and asked[i, cell[j]].all()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class=x><header>Top</header>
<nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice">We use cookies</div><article class="post-12">
<h1>Title &amp; more</h1><p>First <b>bold</b>   text<br><p>Second &lt;b&gt; text</p><script>var a="</p>";</script>
<form><input>Send</form><div class="ad">Buy</div></article><aside>Side</aside><section class="comments"><p>%s</p></section>
<footer>&copy; us</footer></body></html>"""


def test_host_paths_extract_the_article(spark):
    rows = [(i, f"http://h.example/{i}", PAGE % ("Long reader comment. " * 30)) for i in range(4)]
    rows += [(10, None, "<p>No host"), (11, "http://h.example/x", None), (12, "nonsense", ""), (13, "http://h.example/y", "<body><p>Other page</body>")]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in host_paths.extract_pages(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = "Title & more\nFirst bold text\nSecond <b> text"
    assert all(got[i] == (want, len(want)) for i in range(4))
    assert got[10] == ("No host", 7) and got[11] == got[12] == ("", 0) and got[13][0] == "Other page"


WRAPPED = ['<div class="layout has-sidebar">%s</div>', '<div id="page-with-header">%s</div>', '<form id="f">%s</form>',
           '<div class="content-sidebar-wrap">%s</div>', '<div class="layout has-sidebar"><form>%s</form></div>']


@pytest.mark.parametrize("wrap", WRAPPED + ['<div class="content no-comments">%s</div>'])
def test_host_paths_look_into_wrappers(wrap):
    body = "<h1>Title</h1><p>" + "Some words of the article. " * 20 + "</p>"
    want = "Title\n" + ("Some words of the article. " * 20).strip()
    around = "<nav><a href=x>Menu</a></nav><form>Send this</form><div class='comment-list'><p>" + "Long comment. " * 90 + "</p></div>"
    for inner in (f"<article>{body}</article>", f"<main class=x>{body}</main>", f"<div class=post>{body}</div>"):
        page = "<html><body><header>Top</header>" + wrap % (inner + "<div class=sidebar>Side</div>") + "<footer>us</footer></body></html>"
        best, score = host_paths.best_container(host_paths.blocks(page))
        assert best is not None and score > 0 and host_paths.extract(page, None) == want
        if "post" not in inner:
            assert host_paths.extract("<body>" + wrap % inner + around, None) == want
    assert host_paths.extract("<html><body>" + wrap % body + "<aside>Side</aside></body></html>", None) == want


def test_host_paths_do_not_take_comments_for_the_article():
    post = "<div class=post><p>" + "A short post. " * 10 + "</p></div>"
    comments = "<div class=comments><article class=comment><p>" + "Long comment. " * 60 + "</p></article></div>"
    assert host_paths.extract(f"<body>{post}{comments}</body>", None) == ("A short post. " * 10).strip()


def test_host_paths_on_the_pages(spark):
    for r in Q.queries()["op1_host_paths"](spark, SF).join(spark.read.parquet(f"{SF}/pages.parquet"), "page_id").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        want = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inner))
        assert r["text"] == "\n".join(x for x in want if x)


def test_line_rules(spark, odd_docs):
    got = {r["doc_id"]: r for r in line_rules.quality_rules(odd_docs).collect()}
    assert got[1]["n_words"] == 0 and got[1]["base_failed"] and got[6]["kept"] and got[6]["n_repeat_words"] == 0
    assert got[9]["base_failed"] and got[9]["n_repeat_words"] > 5000
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    flood = " ".join(word() for _ in range(30))
    rows = [(i, f"{flood}\n" + " ".join(word() for _ in range(5 if i < 40 else 60)), "h") for i in range(80)]
    verdict = {r["doc_id"]: r["kept"] for r in line_rules.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert verdict[0] and not any(verdict[i] for i in range(1, 40)) and all(verdict[i] for i in range(40, 80))


def brute_left(rows):
    """Rows ``(doc_id, text, source)`` to the kept rows' texts without over-limit lines."""
    norm = lambda x: " ".join(re.split(r"[\x20\x09-\x0D]+", x.lower())).strip(" ")
    first = {}
    for d, t, h in sorted(rows):
        first.setdefault((h, t), d)
    holders = collections.defaultdict(set)
    for (h, t), d in first.items():
        for x in t.split("\n"):
            if norm(x):
                holders[h, norm(x)].add(d)
    docs = collections.Counter(h for h, _ in first)
    over = {k: min(v) for k, v in holders.items() if len(v) > 20 and 100 * len(v) > 10 * docs[k[0]]}
    out = {}
    for d, t, h in rows:
        gone = [x for x in t.split("\n") if over.get((h, norm(x)), d) != d]
        if 100 * sum(len(x.split()) for x in gone) <= 70 * len(t.split()):
            out[d] = "\n".join(x for x in t.split("\n") if x not in gone)
    return out


def test_line_rules_take_the_lines_out_of_the_text(spark):
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    line = lambda n: " ".join(word() for _ in range(n))
    flood, note, rare = line(12), "Read  more\there " + line(4), line(9)
    rows = []
    for i in range(90):
        parts = [line(rng.integers(11, 40)), "", line(8) + "\t"]
        if i % 3:
            parts.insert(int(rng.integers(0, 4)), flood)
        if i % 2:
            parts += [note if i % 4 == 1 else note.upper().replace("\t", "  "), "  "]
        if i % 9 == 0:
            parts.append(rare)
        rows.append((200 - i, "\n".join(parts), "h" if i < 80 else "few"))
    rows += [(300, rows[1][1], "h"), (301, rows[1][1], "other"), (302, "\n".join([flood, note, line(2)]), "h")]
    schema = "doc_id long, text string, source string, n_chars int, lang string"
    docs = spark.createDataFrame([(*r, len(r[1]), "en") for r in rows], schema).repartition(4)
    want = brute_left(rows)
    got = corpus_pipeline.quality_rules(spark, docs, SF)
    assert got.schema.simpleString() == docs.schema.simpleString()
    got = got.collect()
    assert {r["doc_id"]: r["text"] for r in got} == want and len(got) == len(want)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert 302 not in want and sum(flood in want[r[0]] for r in rows if r[0] in want and r[2] == "h") == 1
    assert 30 < sum(want[r[0]] != r[1] for r in rows if r[0] in want) < 80


def test_line_without_any_id_survives_once(spark):
    rows = [(None, f"the same line in each of them\n{i} " + " ".join(f"w{i}x{j}" for j in range(20)), "h") for i in range(30)]
    got = line_rules.keep_good(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == 30 and sum("the same line" in r["text"] for r in got) == 1


def test_intervals(spark):
    entries = spark.createDataFrame(
        [("h", "ads", "2024-01-05", "add"), ("h", "ads", "2024-01-07", "add"), ("h", "ads", "2024-01-09", "remove"),
         ("h", "ads", "2024-01-20", "add"), ("h", "bad", "2024-01-03", "remove"), (None, "ads", "2024-01-01", "add"),
         ("e.org", "ads", "2024-01-02", "add"), ("e.org", "ads", "2024-01-02", "remove")],
        "key string, category string, day string, action string")
    rows = [(1, "http://H/x", "2024-01-05"), (2, "http://h/x", "2024-01-09"), (3, "https://u@h:80/", "2024-02-01"),
            (4, None, "2024-01-05"), (5, "http://a.e.org/", "2024-01-03"), (6, "http://h/", None)]
    caps = spark.createDataFrame(rows, "page_id long, url string, fetch_day string")
    got = {r["page_id"]: r["blocked"] for r in url_intervals.active_entries(caps, entries).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: False, 6: False}


def test_entries_match_at_every_level(spark):
    keys = ["b.example.co.uk", "example.co.uk", "h.org/a/b", "h.org/a/b/c.html?x=1", "org", "h.org/ab", "deep.org/1/2/3/4/5"]
    entries = spark.createDataFrame([(k, f"c{i}", "2024-01-01", "add", "x", 1) for i, k in enumerate(keys)] * 2,
                                    "key string, category string, day string, action string, host string, row int")
    urls = {1: ("http://a.b.example.co.uk/", "c0,c1"), 2: ("http://xb.example.co.uk", "c1"), 3: ("http://h.org/a/b/c.html?x=1#f", "c2,c3,c4"),
            4: ("http://h.org//a/b", "c2,c4"), 5: ("http://h.org/a/bc", "c4"), 6: ("http://example.com/org", ""), 7: ("http://H.ORG/A/b", "c4"),
            8: ("http://deep.org/1/2/3/4/5/6/7", "c4,c6"), 9: ("http://co.uk/x", ""), 10: ("x", ""), 11: ("http://h.org/" + "z/" * 20_000, "c4")}
    caps = spark.createDataFrame([(i, u, "2024-02-01", "clash", "k") for i, (u, _) in urls.items()] * 2,
                                 "page_id long, url string, fetch_day string, host string, key string")
    got = url_intervals.active_entries(caps, entries).collect()
    assert len(got) == 22 and {r["page_id"]: r["categories"] for r in got} == {i: c for i, (_, c) in urls.items()}


def test_pairs_need_both_orders(near_copies):
    """Linked sets share the tokens that the first order asks for."""
    sets = [np.sort(np.array(list({hash(x) for x in shingle_set(t)}), np.int64).view(np.uint64)) for _, t in texts(near_copies)]
    linked = 0
    for i, a in enumerate(sets):
        for b in sets[:i]:
            n = ngram_join._common(a, b)
            if 100 * n >= 75 * (len(a) + len(b) - n) > 0:
                linked += 1
                assert ngram_join._common(ngram_join._prefix(a), ngram_join._prefix(b)) >= ngram_join._slack(min(len(a), len(b)))
    assert linked > 100


def whole_search(lat, text):
    s = lat.normalise(text or "")
    if not s:
        return b"", 0
    best, back = lat.forward(s, [0], len(s))
    return np.array(lat.trace(s, back, len(s))[0], dtype="<u4").tobytes(), best[-1]


@pytest.mark.parametrize("which", ["odd_docs", "small_docs"])
def test_pieces_equal_a_sequential_search(request, which):
    docs = request.getfixturevalue(which)
    lat = viterbi_pieces.lattice(viterbi_pieces.default_path())
    coded = viterbi_pieces.encode_pieces(docs, chunk=300)
    rows = dict(texts(docs))
    got = viterbi_pieces.decode_pieces(coded).collect()
    assert len(got) == len(rows) and max(r["n_chunks"] for r in got) > 5
    for r in got:
        assert (bytes(r["ids"]), r["score"]) == whole_search(lat, rows[r["doc_id"]])
        assert r["text"] == (rows[r["doc_id"]] or "")


def test_word_search_equals_the_lattice_search():
    lat = viterbi_pieces.lattice(viterbi_pieces.default_path())
    rng = np.random.default_rng(6)
    letters = list("aeinrst.,;\n\tAÉß日☃😀\u0301▁")
    words = ["", *("".join(rng.choice(letters, n)) for n in rng.integers(1, 40, 300)), *list(lat.ids)[:300]]
    for s in words:
        assert lat.search(s) == whole_search_of(lat, s) == lat.word(s, {}), s


def whole_search_of(lat, s):
    best, back = lat.forward(s, [0], len(s))
    return np.array(lat.trace(s, back, len(s))[0], dtype="<u4").tobytes(), best[-1]


def test_parts_that_no_piece_joins_are_searched_once(monkeypatch):
    lat = viterbi_pieces.Lattice(viterbi_pieces.default_path())
    assert "t\n" not in lat.inside
    searched = []
    search = lat.search
    monkeypatch.setattr(lat, "search", lambda s: searched.append(s) or search(s))
    texts_ = ["x zebrast", "x zebrast\nOne", "x zebrast\nTwo", "x zebrast\nOne\nTwo"]
    assert lat.encode_many(texts_) == [whole_search(lat, t) for t in texts_]
    assert len(searched) == len(set(searched)) and not any("t\n" in s for s in searched)


def test_max_plus_product_is_associative():
    rng = np.random.default_rng(1)
    a, b, c = rng.integers(-100, 0, (3, 6, 6))
    f = viterbi_pieces.combine
    assert (f(f(a, b), c) == f(a, f(b, c))).all()


def test_toxicity_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    scored = Q.queries()["op8_toxicity"](spark, sf)
    rows = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    hit = sum(r["predicted"] for r in rows if r["toxic"])
    assert hit >= 0.85 * sum(r["toxic"] for r in rows) and hit >= 0.9 * sum(r["predicted"] for r in rows)


def test_toxicity_without_labels(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r["score"], r["predicted"]) for r in toxicity.score_toxicity(odd_docs, none).collect()} == {(0.0, 0)}
    kept = toxicity.score_toxicity(odd_docs, none, keep=tuple(odd_docs.columns))
    assert {c for c in odd_docs.columns} <= set(kept.columns) and kept.count() == odd_docs.count()


def by_definition(text, lexicon):
    """The features of a text, counted by hand."""
    low = text.lower()
    signs = "013457@$!*"
    letter = lambda c: c.isalpha()
    places, i = [], 1
    while i < len(low) - 1:
        if low[i] in signs and letter(low[i - 1]) and letter(low[i + 1]):
            places.append(i)
            i += 2
        i += 1
    chars = list(low)
    for i in places:
        chars[i] = dict(zip("013457@$!", "oieastasi")).get(low[i], "")
    words = "".join(c if not c or letter(c) else " " for c in chars).split()
    clean = " " + " ".join(words) + " "
    hits = [(k, v) for k, v in lexicon for at in range(len(clean)) if clean.startswith(k, at)]
    n = max(1, len(words))
    return {"word_density": sum(k.endswith(" ") for k, _ in hits) / n, "stem_density": sum(not k.endswith(" ") for k, _ in hits) / n,
            "strong_density": sum(v > 3 for _, v in hits) / n, "any_hits": float(bool(hits)), "distinct_hits": float(len({k for k, _ in hits})),
            "exclaim_rate": text.count("!") / n, "masked_rate": len(places) / n, "log_words": float(np.log1p(n)),
            "capital_rate": sum("A" <= c <= "Z" for c in text) / max(1, sum("a" <= c <= "z" or "A" <= c <= "Z" for c in text)),
            "digit_rate": sum(c in "0123456789" for c in text) / max(1, len(text.encode()))}


def test_toxicity_features_equal_their_definition(small_docs):
    lexicon = [(" word ", 4.0), (" the", 1.5), (" idio", 2.0), (" idiot ", 5.0)]
    make = toxicity._Features(lexicon)
    cases = ["", "You idi0t! a1b1c w*rd W0RD", "the then 1a2 x@y@z $$$ h3ll0", "THE É word's été5a"]
    cases += [t or "" for _, t in texts(small_docs)[:40]]
    for t in cases:
        got = dict(zip(toxicity.NAMES, make(t)))
        want = by_definition(t, lexicon)
        assert {k: got[k] for k in want} == pytest.approx(want), t[:80]


def test_toxicity_reads_long_words_in_linear_time():
    start = time.perf_counter()
    toxicity._Features([(" ab", 2.0)])("a" * 1_000_000 + " " + "a1" * 100_000)
    assert time.perf_counter() - start < 5


def test_toxicity_with_clashing_names(spark):
    rows = [(i, ("awful zorg fool you " if i % 3 == 0 else "a calm text about trees ") * 3 + str(i), i % 3 == 0) for i in range(240)]
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, t, 0.5, True, 7, "f", "m", [1], 3) for i, t, _ in rows] + [(None, None, None, None, None, None, None, None, None)],
                                 "doc_id long, text string, score double, Held_Out boolean, predicted int, features string, "
                                 "margin string, rawPrediction array<int>, word_density int")
    out = toxicity.score_toxicity(docs, labels, keep=tuple(docs.columns))
    assert out.count() == 241 and {"kept_score", "kept_Held_Out", "kept_predicted", "features"} <= set(out.columns)
    kept = corpus_pipeline.keep_clean(docs, labels)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    got = {r["doc_id"]: r for r in kept.collect()}
    assert None in got and all(got[i]["score"] == 0.5 for i, _, y in rows if not y) and not any(i in got for i, _, y in rows if y)


def test_near_duplicate_stage_drops_rows_not_ids(spark):
    long = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    rows = [(3, "x"), (5, "x"), (5, "unique"), (7, long), (7, long), (8, long + " phi"), (8, "other text of this id that stays"),
            (None, long), (9, None), (9, ""), (2, "p q"), (2, "p  q"), (2, "p q")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, doc int").repartition(3)
    got = corpus_pipeline.near_duplicate(spark, docs, SF)
    assert got.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    last = [x for x in got if x[0] == 2]
    assert len(last) == 1 and last[0][1] in ("p q", "p  q")
    assert sorted([x for x in got if x[0] != 2], key=str) == sorted(
        [(3, "x"), (5, "unique"), (7, long), (8, "other text of this id that stays"), (None, long), (9, None), (9, "")], key=str)


def test_texts_of_one_id_are_not_mixed_up(spark):
    rng = np.random.default_rng(8)
    text = [" ".join(f"w{x}" for x in rng.integers(0, 10_000, 60)) for _ in range(4)]
    rows = [(1, text[0]), (1, text[1]), (1, text[2][:40]), (5, text[1] + " end"), (6, text[0] + " end"), (7, text[3])]
    got = sorted((r["doc_id"], r["component_id"], r["n_shingles"]) for r in ngram_join.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [x[:2] for x in got] == [(1, 1), (1, 1), (1, 1), (5, 1), (6, 1), (7, 7)]


def test_stages_on_odd_and_empty_tables(spark, odd_docs):
    for docs in (odd_docs, odd_docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "packing" or out.schema.simpleString() == docs.schema.simpleString()
            assert out.count() >= (6 if name == "packing" and docs is odd_docs else 0) and (docs is odd_docs or out.count() == 0)


def test_empty_tables(spark, odd_docs):
    none = odd_docs.limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string, fetch_day date")
    entries = spark.createDataFrame([], "key string, category string, day date, action string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for out in (packing.pack_pieces(none), token_files.read_documents(token_files.write_token_files(none)),
                suffix_family.remove_repeats(none), ngram_join.near_duplicates(none), line_rules.quality_rules(none),
                viterbi_pieces.encode_pieces(none), toxicity.score_toxicity(none, labels), host_paths.extract_pages(pages),
                url_intervals.active_entries(pages, entries), product_quantiser.near_vectors(vectors)):
        assert out.count() == 0


def test_stages_keep_all_columns(spark, odd_docs):
    assert line_rules.keep_good(odd_docs).columns == odd_docs.columns
    assert corpus_pipeline.near_duplicate(spark, odd_docs, SF).columns == odd_docs.columns
    assert suffix_family.remove_repeats(odd_docs, with_text=True).columns == odd_docs.columns


def test_pipeline_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = texts(corpus_pipeline.toxicity(spark, corpus_pipeline.quality_rules(spark, docs, SF), SF))
    first = {d for d, (_, c) in brute_groups(left).items() if d == c}
    left = sorted(x for x in left if x[0] in first)
    want = {}
    seen = set()
    for d, t in left:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in [p for p in range(len(b) - 99) if b[p:p + 100] in seen or seen.add(b[p:p + 100])]:
            gone[p:p + 100] = b"\1" * 100
        want[d] = bytes(c for c, g in zip(b, gone) if not g).decode("utf-8", "ignore")
    want = {d: len(x) + 1 for d, x in ids_of(want.items()).items()}
    got = {r["doc_id"]: r["doc_tokens"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want
