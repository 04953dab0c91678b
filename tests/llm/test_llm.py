"""The operators of opslens.llm against brute force, on small tables and on the given ones."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from opslens.llm import forest, html, langid, lengths, lm, mixing, neargraph, packing, queries, simhash, urls
from opslens.llm.common import components, crc_mod, with_copies
from opslens.llm.tokens import VOCABULARY, encoder, pieces

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _k string, fp string, size int"
ODD = ["", " ", "\n", None, "a", "two words", "de la", "...", "1 2 3", "x" * 5000, "the of and to " * 3000]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns whose names clash."""
    rows = [(i, t, "en" if i % 2 else "fr", f"s{i % 3}", 1, "k", "f", 1) for i, t in enumerate(ODD)]
    rows += [(None, "the of and", None, None, None, None, None, None), (3, None, None, "s1", None, "k", "f", 1)]
    rows += [(20, "the same text again and again", "en", "s0", 1, "k", "f", 1)] * 5
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- 1


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/a>Menu</a></ul></nav><div class="cookie-notice">We use cookies on this site</div>
<main><h1>Head&shy;line &amp; more</h1><p>First   <b>bold</b>
text&nbsp;here.<br>Next line, long enough to be an article about something.<p>Second <script>var x = "</p>";</script>paragraph with <a href="#">a link</a> in it.
<ul><li>one item<li>two item</ul><aside>side text</aside><form><input name=q>Search here</form><!-- no --><div id="comments"><p>Nice post, a comment of a reader</p></div></main>
<div class="ad">Buy now</div><footer>&copy; 2024</footer></body></html>"""


def test_main_text_of_a_full_page():
    assert html.main_text(PAGE).split("\n\n") == [
        "Head\xadline & more", "First bold text here. Next line, long enough to be an article about something.",
        "Second paragraph with a link in it.", "one item", "two item"]


def test_main_text_by_density_alone():
    long = "Words of a long paragraph that runs on and on for a while. " * 5
    page = ("<body><div><a href=1>Home</a> <a href=2>News</a> <a href=3>Sports</a> <a href=4>Contact</a></div>"
            f"<div><div><h2>Title</h2><p>{long}</p><p>{long}</p><p>Short.</p></div></div></body>")
    assert html.main_text(page).split("\n\n") == ["Title", long.strip(), long.strip(), "Short."]


@pytest.mark.parametrize("page", [None, "", "<p", "</p>", "<!--", "<script>x", "<div class='a", "<body></body>", "<a href=x"])
def test_main_text_of_odd_pages(page):
    assert html.main_text(page) == ""


def test_main_text_reads_whole_pages_and_deep_trees():
    assert html.main_text("plain text") == "plain text"
    deep = "<div>" * 5000 + "<p>deep text</p>"
    assert html.main_text(deep) == "deep text"
    assert len(html.main_text("<article>" + "<p>some words</p>" * 20000)) == 20000 * 12 - 2


def test_pages_query_keeps_the_articles(spark, sf_dir):
    got = queries.op1_main_text(spark, sf_dir).toPandas().set_index("page_id")
    want = duckdb.sql(f"select page_id, html from '{sf_dir}/pages.parquet'").fetchall()
    assert len(got) == len(want)
    from html import unescape
    for page_id, page in want:
        article = re.search("<article>(.*?)(</article>|$)", page, re.S)[1]
        blocks = (" ".join(unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article))
        assert got.text[page_id] == "\n\n".join(b for b in blocks if b)
        assert got.n_chars[page_id] == len(got.text[page_id])


# --- 2 and 9


VECTORS = "vec_id long, embedding array<float>, label int"


def cloud(n, seed, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[n // 2: n // 2 + n // 4] = x[0] + 0.15 * rng.normal(size=(n // 4, dim))
    x[-n // 8:] = x[1]
    return x.astype(np.float32)


def odd_vectors(x):
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    n = len(rows)
    bad = [None, [0.0] * x.shape[1], [float("nan")] + [1.0] * (x.shape[1] - 1), [float("inf")] * x.shape[1], [None] + [1.0] * (x.shape[1] - 1)]
    return rows + [(n + i, b, None) for i, b in enumerate(bad)]


def true_links(x, limit=0.9):
    u = x.astype(float)
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    return u @ u.T >= limit


def brute_classes(hit):
    label = np.arange(len(hit))
    for _ in range(len(hit)):
        new = np.array([label[h].min() for h in hit])
        if (new == label).all():
            return label
        label = new


@pytest.mark.parametrize("shard", [1500, 40])
def test_pruned_graph_finds_all_links(spark, shard):
    x = cloud(400, 3)
    hit = true_links(x)
    got = neargraph.near_duplicates(spark.createDataFrame(odd_vectors(x), VECTORS), shard=shard).toPandas().sort_values("vec_id")
    assert len(got) == len(x) + 5
    assert (got.n_links[: len(x)] == hit.sum(1) - 1).mean() > 0.98
    assert (got.component_id[: len(x)] == brute_classes(hit)).all()
    assert (got.n_links[len(x):] == 0).all() and got.kept[len(x):].all()
    assert (got.kept == (got.vec_id == got.component_id)).all()


def test_pruned_graph_of_nothing_and_one(spark):
    assert neargraph.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0
    got = neargraph.near_duplicates(spark.createDataFrame([(5, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (6, None, 0)], VECTORS)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in got) == [(-1, 0, None, False), (5, 0, 5, True), (6, 0, 6, True)]


def brute_nearest(x, ids, asked, k):
    score = x.astype(float) @ x.astype(float).T
    out = {}
    for i in asked:
        s = score[i].copy()
        order = [j for j in np.lexsort([ids, -s]) if j != i][:k]
        out[i] = [(j, s[j]) for j in order]
    return out


def test_forest_reaches_its_recall_and_ranks(spark):
    x = cloud(600, 5)
    x[::7] *= 3
    rows = spark.createDataFrame(odd_vectors(x), VECTORS)
    got = forest.nearest(rows, rows.filter("vec_id % 20 = 0"), leaf=20).toPandas()
    asked = range(0, 600, 20)
    want = brute_nearest(x, np.arange(600), asked, 20)
    hits = 0
    for q in asked:
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21))
        assert np.allclose(mine.score, x[q].astype(float) @ x[mine.vec_id].astype(float).T)
        assert list(zip(-mine.score, mine.vec_id)) == sorted(zip(-mine.score, mine.vec_id))
        # Of equal vectors any of the tied ids would be as near; those found must be as near as the true ones.
        hits += (mine.score.to_numpy() >= want[q][-1][1] - 1e-9).sum()
    assert hits >= 0.95 * 20 * len(asked)


def test_forest_of_few_rows(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0], 0), (20, [1.0, 2.0], 0), (3, [0.5, 0.5], 0), (40, None, 0)], VECTORS)
    got = sorted(tuple(r) for r in forest.nearest(rows, rows.filter("vec_id % 20 = 0")).collect())
    assert got == [(0, 1, 20, 5.0), (0, 2, 3, 1.5), (20, 1, 0, 5.0), (20, 2, 3, 1.5)]
    empty = spark.createDataFrame([], VECTORS)
    assert forest.nearest(empty, empty).count() == 0


def test_embedding_queries(spark, sf_dir):
    x = np.array([r[0] for r in duckdb.sql(f"select embedding from '{sf_dir}/embeddings.parquet' order by vec_id").fetchall()])
    got = queries.op2_pruned_graph(spark, sf_dir).toPandas().sort_values("vec_id")
    assert (got.n_links.to_numpy() == true_links(x).sum(1) - 1).all()
    near = queries.op9_rp_forest(spark, sf_dir).toPandas()
    want = brute_nearest(x, np.arange(len(x)), range(0, len(x), 20), 20)
    found = {(q, v) for q, v in zip(near.query_id, near.vec_id)}
    assert np.mean([(q, j) in found for q in want for j, _ in want[q]]) >= 0.9


# --- 3


RULES = [("com", "/"), ("example.com", "/en/"), ("www.example.com", "/en/"), ("net", "/es/"), ("net", "/fr/"), ("a.net", "/"), ("a.net", "/x"), ("a.net", "/x/y")]


def brute_rule(host, path, rules):
    fit = [(len(h.split(".")), len(p), h, p) for h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return "".join(max(fit)[2:]) if fit else None


def test_rules_nest_and_reach_subdomains(spark):
    given = ["http://EXAMPLE.com/en/x?q", "https://www.example.com/en/", "http://b.a.net/x/y/z#t", "http://a.net/xy", "http://ba.net/x", "ftp://net/es/",
             "x://com", "x://com/", "no scheme/com/", "", None, "http://", "://a.net/x?/x/y", "http://exa.mple.com/EN/", "http://a.net", "http://.com/", "http://Ä.com/"]
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(given * 2)], "page_id long, url string, host string, _row string")
    rules = spark.createDataFrame([(h, p, "block" if i % 2 else "allow") for i, (h, p) in enumerate(RULES)] + [(None, "/", "block")], "host string, path string, verdict string")
    got = {r.page_id: r for r in urls.judge(pages, rules).collect()}
    assert len(got) == 2 * len(given)
    for i, u in enumerate(given * 2):
        rest = re.split("[?#]", u.split("://", 1)[1])[0] if u and "://" in u else ""
        host, slash, path = rest.partition("/")
        host, path = low(host), slash + path
        rule = brute_rule(host, path, RULES)
        want = "allow" if rule is None else ("block" if [h + p for h, p in RULES].index(rule) % 2 else "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict, got[i]._row) == (host, path, rule, want, "clash"), u
    assert {r.verdict for r in urls.judge(pages, rules.limit(0)).collect()} == {"allow"}
    assert urls.judge(pages.limit(0), rules).count() == 0


def test_url_plan_is_native(spark, sf_dir):
    plan = queries.op3_url_rules(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow"):
        assert bad not in plan


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, sf_dir, name):
    from tools.check_sql import compare, connect

    diff, rows = compare(spark, connect(sf_dir), name, queries.queries()[name], queries.oracle_sql()[name], sf_dir)
    assert diff is None and rows > 0


# --- 4 and 10


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


def test_ids_are_those_of_the_tokenizer(tokenizer):
    rng = np.random.default_rng(1)
    parts = [" ", "  ", "\n", "\t", "a", "bc", "é", "12", "'s", "'", ".", ",", "!", "<|endoftext|>", "日本", "\u00a0", "x y", "\r", "\x1c", "\u3000", "Word,", "😀"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 14))) for _ in range(4000)] + ["the cat sat on the mat. " * 500, "x" * 3000]
    for text, ids in zip(texts, encoder().ids(texts)):
        assert "".join(pieces(text)) == text
        assert np.frombuffer(ids, np.uint32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, fill = packing.best_fit([7, 6, 4, 3, 3], 10)
    assert (bins, offsets, fill) == ([0, 1, 1, 0, 2], [0, 0, 6, 7, 0], [10, 10, 3])


def check_packing(rows, texts, tokenizer, length):
    """rows: doc_id, piece, start, length, crc, sequence, offset; texts by doc_id, which may repeat."""
    by_sequence = defaultdict(list)
    for doc, piece, start, n, crc, seq, offset in rows:
        by_sequence[seq].append((offset, n))
        ids = tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids + [0]
        assert zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes()) == crc
        assert (n == length or piece == 0) and start + n <= len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    total = sum(r[3] for r in rows)
    assert total == sum(len(tokenizer.encode(texts[d] or "", add_special_tokens=False).ids) + 1 for d, *rest in rows if rest[0] == 0)
    return len(by_sequence), total


def test_packing_is_whole_and_tight(spark, sf_dir, docs, tokenizer):
    texts = dict(docs.select("doc_id", "text").collect())
    rows = [tuple(r) for r in queries.op4_best_fit(spark, sf_dir).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()]
    assert {r[0] for r in rows} == set(texts)
    bins, total = check_packing(rows, texts, tokenizer, 2048)
    assert bins <= 1.03 * -(-total // 2048)


def test_packing_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_ITEMS", 50)
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 101, 1000)
    items = spark.createDataFrame([(i, int(n)) for i, n in enumerate(sizes)], "uid long, length long")
    got = packing.places(items, 100, slack=2).collect()
    assert len({r.uid for r in got}) == len(got) == 1000
    fill = defaultdict(list)
    for r in got:
        fill[r.sequence_id].append((r.offset, int(sizes[r.uid])))
    for parts in fill.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 100
    assert len(fill) <= 1.06 * sizes.sum() / 100


def test_packing_of_odd_rows(spark, odd, tokenizer):
    packed = packing.pack(odd, length=64)
    rows = packed.pieces.join(packed.places, "uid")
    assert rows.filter("piece = 0").count() == odd.count() == rows.select("doc_id", "_d", "_k", "piece", "uid").filter("piece = 0").count()
    assert packed.pieces.agg(F.sum("length")).first()[0] == sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd.collect())
    sequences = packed.sequences().collect()
    assert max(len(s.ids) for s in sequences) <= 4 * 64 and sum(len(s.ids) for s in sequences) == 4 * packed.pieces.agg(F.sum("length")).first()[0]
    empty = packing.pack(odd.limit(0))
    assert empty.pieces.join(empty.places, "uid").count() == 0


def test_lengths_answer_every_limit(spark, odd, tokenizer):
    true = [len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in odd.collect()]
    got = {r.length: r for r in lengths.by_limit(lengths.histogram(odd)).collect()}
    assert set(got) == set(true)
    for n, r in got.items():
        assert (r.docs, r.tokens, r.docs_over) == (true.count(n), n * true.count(n), sum(t > n for t in true))
        assert (r.tokens_over, r.docs_total, r.tokens_total) == (sum(t for t in true if t > n), len(true), sum(true))
        assert r.tokens_kept == sum(min(t, n) for t in true) and r.share_fit == sum(t <= n for t in true) / len(true)
    assert lengths.by_limit(lengths.histogram(odd.limit(0))).count() == 0


# --- 5


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, closed, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in closed]
        share = {s: left * weight[s] / sum(weight[t] for t in rest) for s in rest}
        over = [s for s in rest if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            closed.add(s)
            target[s] = 2.0 * sizes[s]
            left -= target[s]


@pytest.mark.parametrize("given", ["docs", "odd"])
def test_mix_meets_its_targets(spark, request, given, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 7)
    table = request.getfixturevalue(given)
    rows = table.select("doc_id", "text", "source").collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(words(r.text))
    want = brute_targets(sizes)
    mixed = mixing.mix(table).collect()
    assert Counter((r.doc_id, r.size) for r in mixed) == Counter((r.doc_id, len(words(r.text))) for r in rows)
    taken, largest = Counter(), Counter()
    for r in mixed:
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == len(r.positions) * r.size <= 2 * r.size and all(0 <= p <= 1 for p in r.positions)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    assert sorted(map(str, mixing.mix(table).collect())) == sorted(map(str, mixed))


def test_positions_invert_the_schedule(spark):
    shares = spark.range(101).select((F.col("id") / 100).alias("u"))
    for which, knots in enumerate(mixing.SCHEDULES):
        got = [r[1] for r in shares.select("u", mixing.position(F.col("u"), F.lit(which)).alias("t")).orderBy("u").collect()]
        grid = np.linspace(0, 1, 200001)
        rate = np.interp(grid, *zip(*knots))
        area = np.concatenate([[0], np.cumsum((rate[1:] + rate[:-1]) / 2)])
        assert np.allclose(np.interp(np.arange(101) / 100, area / area[-1], grid), got, atol=1e-4)


def test_training_order_is_sorted(spark, docs):
    order = mixing.training_order(mixing.mix(docs)).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert mixing.mix(docs.limit(0)).count() == 0


# --- 6


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op6_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert got.held_out.tolist() == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]
    assert (got.lang_pred == got.lang)[got.held_out].mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_filters_find_what_was_put_in(spark, odd):
    model = langid.fit(odd)
    rows = langid.predict(odd, model).collect()
    assert len(rows) == odd.count()
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in rows)
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    held = model.counts([b"the of and to", "x".encode() * 5000])
    assert (held[1].max(1) == held[0]).all()
    assert langid.fit(odd.limit(0)).langs == ()
    assert {r.lang_pred for r in langid.predict(odd, langid.fit(odd.limit(0))).collect()} == {"und"}
    assert langid.predict(odd.limit(0), model).count() == 0


def test_long_texts_count_as_their_pieces(spark, odd, monkeypatch):
    model = langid.fit(odd)
    text = ("the of and to " * 3000).encode()
    whole = model.predict([text])
    monkeypatch.setattr(langid, "BATCH_BYTES", 1000)
    assert model.predict([text]).equals(whole)


# --- 7


def brute_base(rows):
    """rows: (text, held_out)."""
    split = [(words(low(t)) + [None], h) for t, h in rows]
    count = Counter(w for ws, h in split if not h for w in ws)
    n, v = sum(count.values()), len(count)
    return [(len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for ws, _ in split]


@pytest.mark.parametrize("chunk", [4 << 20, 3000])
def test_base_scores_and_gain(spark, sf_dir, docs, chunk, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 10 * chunk)
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    held = [zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in rows]
    got = queries.op7_backoff(spark, sf_dir).toPandas().sort_values("doc_id")
    assert got.held_out.tolist() == held
    want = brute_base([(r.text, h) for r, h in zip(rows, held)])
    for mine, true in zip(zip(got.n_tokens, got.n_known, got.train_tokens, got.base_score), want):
        assert mine[:3] == true[:3] and mine[3] == pytest.approx(true[3])
    assert got.score[got.held_out].sum() > got.base_score[got.held_out].sum()


def brute_scores(rows):
    """rows: (text, held_out). The backoff model by dictionaries: weights chosen leaving each training token out."""
    split = [([lm.START] + words(low(t)) + [None], h) for t, h in rows]
    word = Counter(w for ws, h in split if not h for w in ws[1:])
    pair = Counter(p for ws, h in split if not h for p in zip(ws, ws[1:]))
    word[lm.START] = word[None]
    n, v = sum(c for w, c in word.items() if w != lm.START), sum(1 for w in word if w != lm.START and word[w])

    def parts(v_, w, less):
        c, joint = word[v_] - less, pair[v_, w] - less
        plain = (word[w] - less + 0.5) / (n - less + 0.5 * (v + 1))
        return (min(int(math.log2(c)) // 2, lm.CLASSES - 1), joint / c, plain) if c > 0 else (None, 0, plain)

    gain = np.zeros((lm.CLASSES, len(lm.GRID)))
    for ws, h in split:
        for p in zip(ws, ws[1:]) if not h else ():
            k, arc, plain = parts(*p, 1)
            if k is not None:
                gain[k] += [math.log10(x * arc + (1 - x) * plain) for x in lm.GRID]
    best = [lm.GRID[i] for i in gain.argmax(1)]

    def one(p):
        k, arc, plain = parts(*p, 0)
        return math.log10(plain if k is None else best[k] * arc + (1 - best[k]) * plain)

    return [sum(map(one, zip(ws, ws[1:]))) for ws, _ in split], best


def test_automaton_walks_like_brute_force(spark, docs):
    table = docs.select("doc_id", "text", (crc_mod(F.col("doc_id"), 5) == 1).alias("held_out"))
    rows = table.orderBy("doc_id").collect()
    want, weights = brute_scores([(r.text, r.held_out) for r in rows])
    got = [r.score for r in lm.score(table).orderBy("doc_id").collect()]
    assert got == pytest.approx(want) and max(weights) > 0


def test_scores_of_odd_rows(spark, odd):
    rows = lm.score(odd.withColumn("held_out", F.lit(None).cast("boolean"))).collect()
    assert len(rows) == odd.count()
    assert Counter(r.n_tokens for r in rows) == Counter(len(words(r.text)) + 1 for r in odd.collect())
    assert lm.score(odd.limit(0).withColumn("held_out", F.lit(False))).count() == 0
    unseen = lm.score(odd.withColumn("held_out", F.lit(True))).collect()
    assert all(r.train_tokens == 0 and r.score == pytest.approx(r.base_score) for r in unseen)


# --- 8


def brute_fingerprint(text):
    ws = words(low(text))
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps):
    """The smallest index reachable over pairs of at most 2 differing bits."""
    x = np.array(fps, np.uint64)
    return brute_classes(np.bitwise_count(x[:, None] ^ x[None, :]) <= 2)


def test_fingerprints_and_groups(spark, sf_dir, docs):
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    got = queries.op8_simhash(spark, sf_dir).toPandas().sort_values("doc_id")
    assert got.fingerprint.tolist() == [f"{f:016x}" for f in fps]
    assert got.component_id.tolist() == [rows[i].doc_id for i in brute_groups(fps)]


@pytest.mark.parametrize("cell", [4096, 20])
def test_pivots_lose_no_pair(spark, cell, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell)
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 2**63, 30, np.uint64)
    fps = set()
    for c in centres:
        for _ in range(40):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                x ^= 1 << int(b)
            fps.add(x)
    # A chain whose ends are far apart, and a dense cell.
    fps |= {sum(1 << b for b in range(2 * i)) for i in range(32)} | {1 << 63 | i for i in range(60)}
    fps = sorted(fps)
    table = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    got = {r.fp: r.group for r in simhash.groups(table).collect()}
    want = brute_groups(fps)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    mine = defaultdict(set)
    true = defaultdict(set)
    for s, w in zip(signed, want):
        mine[got[s]].add(s)
        true[w].add(s)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, true.values()))


def test_classes_of_odd_rows(spark, odd):
    rows = simhash.classes(odd).collect()
    assert len(rows) == odd.count()
    none = {r.component_id for r in rows if r.fp == 0}
    assert none == {0}
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert simhash.classes(odd.limit(0)).count() == 0


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (200, 201), (201, 202), (5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(41)} | {got[100]} == {0} and {got[i] for i in (200, 201, 202)} == {200}


# --- pipeline


def test_with_copies_counts_repeated_rows(spark, odd):
    keys = odd.select("doc_id", *simhash.row_key())
    twice = with_copies(odd, keys.select("_d", "_k", F.lit(1).alias("rows"), F.lit(2).alias("copies")))
    # Rows that differ in other columns alone are told apart no further.
    assert Counter((r.doc_id, r.text) for r in twice.collect()) == Counter((r.doc_id, r.text) for r in odd.collect() for _ in range(2))
    assert twice.columns == odd.columns


def brute_pipeline(rows):
    """Of rows (doc_id, text, source), how often each doc_id is packed; every text here has a known language."""
    fps = [brute_fingerprint(r.text) for r in rows]
    kept = [r for i, (r, g) in enumerate(zip(rows, brute_groups(fps))) if g == i]
    sizes = Counter()
    for r in kept:
        sizes[r.source] += len(words(r.text))
    target, stream, copies = brute_targets(sizes), Counter(), Counter()
    import hashlib
    for r in sorted(kept, key=lambda r: (hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.doc_id)):
        n = len(words(r.text))
        copies[r.doc_id] = sum(k * sizes[r.source] + stream[r.source] + n / 2 <= target[r.source] for k in range(2)) if n else 0
        stream[r.source] += n
    return +copies


def test_pipeline_against_brute_force(spark, sf_dir, docs, tokenizer):
    rows = docs.select("doc_id", "text", "source").orderBy("doc_id").collect()
    got = [tuple(r) for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()]
    assert Counter(r[0] for r in got if r[1] == 0) == brute_pipeline(rows)
    check_packing(got, {r.doc_id: r.text for r in rows}, tokenizer, 2048)


def test_stages_keep_the_columns(spark, odd, sf_dir):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == odd.columns and docs.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), sf_dir).count() == 0


def test_language_stage_drops_only_what_it_rejects(spark, docs, sf_dir):
    extra = spark.createDataFrame([(-1, None), (-2, "123 456"), (-3, "жщ цйъ фыва " * 20)], "doc_id long, text string")
    kept = corpus_pipeline.keep_known_languages(spark, docs.unionByName(extra, allowMissingColumns=True), sf_dir)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_counts_survive_the_exchange_at_any_size():
    for n in ([], [0], [1, 254, 255, 256], [2**32 - 2, 7, 2**32 - 1, 2**32, 255, 2**40, 0]):
        assert lm._unpack_counts(lm._pack_counts(np.array(n, np.int64))).tolist() == n


@pytest.mark.parametrize("log2_buckets", [0, 3, 16, 20])
def test_chunk_writes_only_to_buckets_it_has_grams_in(log2_buckets):
    import pyarrow as pa

    texts = [b"a b a b c", b"", None, b"B c"]
    rows = pa.table({"chunk": pa.array([5] * 4, pa.int64()), "text": pa.array(texts, pa.binary()), "held_out": [False, False, True, False]})
    asked = lm._ask(log2_buckets)(rows)
    assert asked.num_rows <= min(1 << log2_buckets, 4 + 7)
    buckets = asked.column("bucket").to_pylist()
    assert buckets == sorted(set(buckets)) and max(buckets) < 1 << log2_buckets
    answers = lm._answer(asked)
    for name, most in (("word_n", [2, 2, 3, 3]), ("pair_n", [1, 1, 1, 1, 2, 2, 2])):
        counts = np.concatenate([lm._unpack_counts(x) for x in answers.column(name).to_pylist()]).tolist()
        assert sorted(counts) == most


def test_train_totals(spark, docs):
    table = docs.select("doc_id", F.col("text").cast("binary").alias("text"), (F.col("doc_id") % 5 == 1).alias("held_out"))
    seen = Counter()
    for row in docs.filter("doc_id % 5 != 1").select("text").collect():
        seen.update([*words(low(row.text or "")), None])
    assert lm.train_totals(table) == (sum(seen.values()), len(seen))
    assert lm.train_totals(table.limit(0)) == (0, 0)


def test_audit_short_of_recall_warns(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.warns(UserWarning, match="audit"):
        out = neargraph.near_duplicates(rows, recall=2.0).collect()
    assert {r.vec_id: r.component_id for r in out} == {1: 1, 2: 1, 3: 3}


def test_dense_group_over_many_shards_is_compared_in_full(spark, monkeypatch):
    monkeypatch.setattr(neargraph, "SLICE_BYTES", 64 * 8 * 500)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1500, 64))
    x[:1200] = rng.normal(size=64) + 0.23 * rng.normal(size=(1200, 64))
    x[-20:] = x[0]
    hit = true_links(x)
    with pytest.warns(UserWarning, match="audit"):
        rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        got = neargraph.near_duplicates(rows, shard=10, overlaps=(3,)).toPandas().sort_values("vec_id")
    assert got.n_links.tolist() == (hit.sum(1) - 1).tolist()
    assert got.component_id.tolist() == brute_classes(hit).tolist()


def test_overlap_grows_until_rare_pairs_meet(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=(300, 64))
    side -= (side * x[:300]).sum(1, keepdims=True) * x[:300]
    x[-300:] = 0.905 * x[:300] + np.sqrt(1 - 0.905**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    assert neargraph.meeting(x[:256], x[300:600], 0.9, 3) < 0.95 and neargraph.meeting(x[:256], x[300:600], 0.9, 300) == 1
    hit = true_links(x)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = neargraph.near_duplicates(rows, shard=10).toPandas().sort_values("vec_id")
    assert (got.n_links == hit.sum(1) - 1).mean() >= 0.99
    assert (got.n_links[:300] == hit.sum(1)[:300] - 1).mean() >= 0.98


STORY = "Words of a long paragraph that runs on and on for a while. " * 5
TEASERS = "".join(f"<article><a href=/{i}>Another story {i}</a> <a href=/{i}>More on it</a></article>" for i in range(4))


@pytest.mark.parametrize("page", [
    f"<body><article><h1>Title</h1><p>{STORY}</p><p>{STORY}</p></article>{TEASERS}</body>",
    f"<body><main><div><h1>Title</h1><p>{STORY}</p><p>{STORY}</p></div><div>{TEASERS}</div><p><a href=/t>Terms</a> <a href=/p>Privacy</a></p></main></body>"])
def test_density_decides_on_pages_with_named_elements(page):
    assert html.main_text(page).split("\n\n") == ["Title", STORY.strip(), STORY.strip()]


@pytest.mark.parametrize("wrapper", [
    "<div class='page has-sidebar'>", "<div class='no-comments'>", "<div id='site-with-menu'>", "<div class='post share-enabled'>", "<div class='no-header'>"])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<main>{}</main>", "{}"])
def test_marked_wrappers_do_not_empty_the_page(wrapper, inner):
    story = inner.format(f"<h1>Title</h1><p>{STORY}</p><p>{STORY}</p>")
    page = (f"<body><header><h1>Site</h1></header>{wrapper}{story}<div class=sidebar><article><p>Some other story</p></article></div>"
            f"<div id=comments><article><p>A comment of a reader</p></article></div></div></body>")
    assert html.main_text(page).split("\n\n") == ["Title", STORY.strip(), STORY.strip()]
    plain = f"<body><header><h1>Site</h1></header>{wrapper}<p>{STORY}</p><p>{STORY}</p><div class=sidebar>Side</div></div><footer>Foot</footer></body>"
    assert html.main_text(plain).split("\n\n") == [STORY.strip(), STORY.strip()]
