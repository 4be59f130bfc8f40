"""Page text, token counts, secrets, quality and neighbours against brute force, libraries and held-out labels."""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pytest

from reqmart.llm import ordinal_quality as quality, page_text, projected_neighbours as near, secret_index, token_counts
from reqmart.llm.queries import QUERIES, graded, tokenizer
from tests.conftest import SF_DIR, rows
from tests.llm import samples

PAGES = [
    (1, None, ""),
    (2, "", ""),
    (3, "<article><h1>A &amp; B</h1><p>x  y\n z&nbsp;<b>w</b>v<br>u</p></article>", "A & B\nx y z wv u"),
    (4, "<nav><li><a href='/'>Home</a></li></nav><article><p>one<p>two &lt;3</article><footer>f</footer>", "one\ntwo <3"),
    (5, "<article><p>t</p><script>var a='<p>no</p>';</script><!-- <p>no</p> --><style>p{}</style><p>u", "t\nu"),
    (6, "<article>a<aside>b</aside><form>c<p>d</p></form><div class='ad box'>e</div><p>f</p>"
        "<section id=\"readerComments\"><p>g h i</p></section></article>", "a\nf"),
    (7, "<header><h1>Site</h1></header><main><p>body text</p><div class=\"cookieNotice\">ok?</div></main>", "body text"),
    (8, "<article><p title='a > b'>k</p><p>1 < 2 and 3</p></article>", "k\n1 < 2 and 3"),
    (9, "<<<>>< <article <p>", None),
    (10, "<article><p>" + "long " * 50_000 + "</p></article>", " ".join(["long"] * 50_000)),
]


def test_pages(spark):
    data = [(i, f"http://{i}", h, "x", "y") for i, h, _ in PAGES + [(None, "<article>n</article>", "n")]]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, text string, words string")
    got = {r["page_id"]: r["text"] for r in page_text.extract(pages).collect()}
    for page_id, _, text in PAGES:
        assert text is None or got[page_id] == text, page_id
    assert got[None] == "n"


def test_names_around_an_article_do_not_count():
    tree = page_text.grow(*page_text.labelled_table())
    body = "<h1>title</h1><p>one two three</p><section id='discussion'><h2>Discussion</h2><p>four five</p></section>"
    text = "title\none two three\nDiscussion\nfour five"
    comments = "<div id=comments><article class='comment-body'><p>a comment of some words</p></article></div>"
    cards = "<div class=related><article><p>first card</p></article><article><p>second card</p></article></div>"
    for name in ("page has-sidebar", "with-comments", "layout-sidebar", "page noAds", "search-page"):
        for page in (
            f"<div class='{name}'><article>{body}</article></div>",
            f"<div class='{name}'><div class=sidebar>x y</div><article>{body}</article>{comments}{cards}</div>",
            f"<div class='{name}'><main>{body}<div class=promo>buy it</div></main><footer>end</footer></div>",
            f"<main><div id='{name}'><article class='post has-comments'>{body}</article></div>{comments}</main>",
            f"<form id='{name}'><main><article>{body}</article>{cards}</main></form>",
            f"<main>{body}{cards}</main>",
        ):
            assert page_text.main_text(page, tree) == text, page
    assert page_text.main_text(f"<article>{body}</article><aside><article><p>a b c</p></article></aside>", tree) == text
    # A comment section stays out, within an article too, also as articles of their own.
    page = f"<article>{body}<section id='readerComments'><article><p>a b c</p></article></section></article>"
    assert page_text.main_text(page, tree) == text


def test_articles_of_the_table(spark):
    got = QUERIES["op2_page_text"](spark, SF_DIR).collect()
    pages = dict(samples.table_rows(SF_DIR, "pages", "page_id, html"))
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.DOTALL)[1]
        parts = (page_text.html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))) for p in re.split("</?(?:p|h1)>", article))
        assert r["text"] == "\n".join(" ".join(p.split()) for p in parts if p.strip())
        assert r["n_chars"] == len(r["text"])


def used(tree):
    return set() if tree.feature < 0 else {page_text.FEATURES[tree.feature]} | used(tree.low) | used(tree.high)


def test_the_tree_goes_by_densities_and_neighbours():
    features, labels = page_text.labelled_table()
    tree = page_text.grow(features, labels)
    assert (tree.takes(features) == labels).mean() > 0.98
    assert page_text.FEATURES[tree.feature] == "link_density"
    assert used(tree) & {"words_before", "link_density_before", "words_after", "link_density_after"}


W20, W50 = " ".join(f"w{n}" for n in range(20)), " ".join(f"v{n}" for n in range(50))
UNNAMED = [
    (f"<div><h1>My title</h1><p>{W50}</p><p>Yes.</p></div>", f"My title\n{W50}\nYes."),
    ("<p>one two</p><p>three four five</p><p>six</p>", "one two\nthree four five\nsix"),
    (f"<div>{''.join(f'<p><a href=x>link {n} {W20}</a></p>' for n in range(3))}</div>", ""),
    (f"<ul>{''.join(f'<li><a href=x>{W20}</a></li>' for _ in range(4))}</ul><p>{W50}</p>", W50),
    (f"<div><a href=x>{W20}</a> <a href=x>{W20}</a></div>", ""),
    (f"<article><div class='post-content social-science'><p>{W20}</p><p>Yes.</p></div></article>", f"{W20}\nYes."),
    (f"<article><p>{W20}</p><div class='market-share'><p>{W50}</p></div></article>", f"{W20}\n{W50}"),
    (f"<article><p>{W20}</p><p class='advert'>{W50}</p><div class=share>a b</div></article>", W20),
    (f"<article><p>{W20} <span class='sponsored'>{W50}</span></p></article>", W20),
    (f"<article><p>{W20}</p></article><div><p>{W50}</p></div>", W20),
]


@pytest.mark.parametrize("page, text", UNNAMED)
def test_pages_that_names_do_not_tell(page, text):
    assert page_text.main_text(page, page_text.grow(*page_text.labelled_table())) == text


def test_repeated_pages_and_an_empty_table(spark):
    kind = "page_id long, url string, html string"
    data = [(1, "u", "<p>a b</p>"), (1, "u", "<p>a b</p>"), (None, None, None)]
    assert rows(page_text.extract(spark.createDataFrame(data, kind))) == [(None, None, ""), (1, "u", "a b"), (1, "u", "a b")]
    assert page_text.extract(spark.createDataFrame([], kind)).count() == 0


def unigram():
    from tokenizers import Tokenizer, models, pre_tokenizers

    library = Tokenizer(models.Unigram(token_counts.vocabulary(tokenizer("piece_bpe_32k.model")), 0, True))
    library.pre_tokenizer = pre_tokenizers.Metaspace()
    return lambda text: len(library.encode(text or "", add_special_tokens=False).ids)


def test_token_counts(spark):
    count = unigram()
    got = QUERIES["op3_token_counts"](spark, SF_DIR)
    assert sorted(map(tuple, got.collect())) == [(i, count(t)) for i, t in samples.table_rows(SF_DIR, "documents", "doc_id, text")]
    docs = samples.awkward() + [(40, "  a  b ", "x"), (41, "<s> <0x0A>\n\n", "x"), (42, "☃☃ ▁▁x", "x"), (43, "\n", "x")]
    got = token_counts.token_counts(samples.documents(spark, docs), tokenizer("piece_bpe_32k.model"))
    assert sorted(map(str, got.collect())) == sorted(f"Row(doc_id={i}, n_tokens={count(t)})" for i, t, _ in docs)
    assert token_counts.token_counts(samples.documents(spark, []), tokenizer("piece_bpe_32k.model")).count() == 0


ASSIGN = r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_secrets(spark):
    odd = [
        (50, 'x Password = "abcdefgh" PASSWD:short token==token=12345678', "x"), (51, "AKIA" + "Z" * 12 + " AKIAZ", "x"),
        (52, "é" * 10 + "ab" * 16 + "g" + "0" * 31, "x"), (53, "paſsword=abcdefgh api_key:'k/+_.=-9' APIKEY = 12345678", "x"),
        (54, "ghp_" + "aZ" * 18 + " xoxb-1234567890 -----BEGIN RSA PRIVATE KEY-----", "x"), (55, "secret" + " " * 5000 + "=abcdefgh", "x"),
    ]
    docs = samples.awkward() + odd + [(i, t, "x") for i, t in samples.table_rows(SF_DIR, "documents", "doc_id + 1000, text")]
    found = secret_index.find_secrets(samples.documents(spark, docs))
    got = {(r["doc_id"], tuple((s["kind"], s["start"], s["end"]) for s in r["spans"])) for r in found.collect()}
    kinds = [r.kind for r in secret_index.BASE_RULES]
    base = {(i, tuple(s for s in spans if s[0] in kinds)) for i, spans in got}
    assert base == {(i, tuple((kinds[k], s, e) for s, k, e in base_spans(t or ""))) for i, t, _ in docs}
    assert {s[0] for i, spans in got if i == 54 for s in spans} == {"code_host", "chat", "private_key"}
    assert secret_index.find_secrets(samples.documents(spark, [])).count() == 0


def test_secret_digest(spark):
    kinds = ["assign", "access", "hex"]
    for r in QUERIES["op6_secret_index"](spark, SF_DIR).collect():
        text = dict(samples.table_rows(SF_DIR, "documents", "doc_id, text"))[r["doc_id"]] if r["spans"] else ""
        joined = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in base_spans(text))
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


@pytest.mark.parametrize("pattern, expected", [
    ("abcd", secret_index.All((b"abc", b"bcd"))),
    ("ABC|xyz", secret_index.Any((b"abc", b"xyz"))),
    ("ab", None),
    ("[0-9a-f]{32,}", None),
    ("(abc)?def", secret_index.Any((secret_index.All((b"abc", b"bcd", b"cde", b"def")), b"def"))),
    ("abc.*", b"abc"),
    (".abc", b"abc"),
])
def test_trigram_queries(pattern, expected):
    assert secret_index.trigram_query(pattern) == expected


def labelled(sf_dir):
    texts = dict(samples.table_rows(sf_dir, "documents", "doc_id, text"))
    labels = samples.table_rows(sf_dir, "labels", "doc_id, quality, toxic")
    return [(texts[i], 0 if q == 0 else 1 if t else 2) for i, q, t in labels if i in texts]


def test_quality_on_held_out_labels():
    data = labelled("/root/testdata/sf0.1")
    features = [np.array(sorted({quality.hashed(t) for t in quality.tokens_of(text)})) for text, _ in data]
    grades = np.array([g for _, g in data])
    fitted = np.arange(len(data)) % 4 > 0
    model = quality.learn([f for f, x in zip(features, fitted) if x], grades[fitted], 3)
    scores = np.array([sum(model.weights.get(int(k), 0.0) for k in f) for f, x in zip(features, fitted) if not x])
    tails, truth = model.tails(scores), grades[~fitted]
    assert (tails[:, 0] >= tails[:, 1]).all()
    kept = tails[:, 1] >= 0.8
    assert kept[truth == 2].mean() > 0.95 and kept[truth == 1].mean() < 0.15 and kept[truth == 0].mean() < 0.03


def test_quality_of_awkward_documents(spark):
    docs = samples.documents(spark, samples.awkward())
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, None), (None, 1, 1), (9, 0, 1), (1, 1, 0), (4, None, 1)], "doc_id long, quality int, toxic int")
    got = graded(docs, labels)
    assert got.select("doc.*").columns == docs.columns and got.count() == docs.count()
    assert all(0 <= r["tail"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in got.collect())
    unrated = quality.fit(docs, labels.where("false").selectExpr("doc_id", "quality AS grade"), 3)
    assert not unrated.weights and rows(unrated.score(docs).select("tail").distinct()) == [(pytest.approx(1 / 3, abs=1e-6),)]
    assert graded(samples.documents(spark, []), labels).count() == 0


def plain_fit(examples, n_grades, passes=20, batch=64, step=1.0, l1=20.0, l2=0.01):
    """The regression, one example and one weight at a time."""
    def sigmoid(x):
        return 1 / (1 + math.exp(-min(max(x, -35), 35)))

    seen = {}
    for features, _ in examples:
        for f in features:
            seen[f] = seen.get(f, 0) + 1
    least = max(2, len(examples) // 1000)
    data = [(sorted(f for f in features if seen[f] >= least), grade) for features, grade in examples]
    shares = [(sum(g == k for _, g in data) + 1) / (len(data) + n_grades) for k in range(n_grades)]
    below = [sum(shares[: k + 1]) for k in range(n_grades - 1)]
    thresholds = [math.log(b / (1 - b)) for b in below]
    weights, sums, squares = {}, {}, {}
    order = np.random.default_rng(7)
    for _ in range(passes):
        for rows_ in np.array_split(order.permutation(len(data)), max(1, len(data) // batch)):
            edges = [-math.inf, *thresholds, math.inf]
            gradient, moves = {}, [0.0] * (n_grades - 1)
            for i in rows_:
                features, grade = data[i]
                score = sum(weights.get(f, 0.0) for f in features)
                upper, lower = sigmoid(edges[grade + 1] - score), sigmoid(edges[grade] - score)
                for f in features:
                    gradient[f] = gradient.get(f, 0.0) + 1 - upper - lower
                share = max(upper - lower, 1e-6)
                if grade < n_grades - 1:
                    moves[grade] += upper * (1 - upper) / share
                if grade > 0:
                    moves[grade - 1] -= lower * (1 - lower) / share
            for f, g in gradient.items():
                grown = squares.get(f, 0.0) + g * g
                w = weights.get(f, 0.0)
                sums[f] = sums.get(f, 0.0) + g - (math.sqrt(grown) - math.sqrt(squares.get(f, 0.0))) / step * w
                squares[f] = grown
                shrunk = math.copysign(max(abs(sums[f]) - l1, 0.0), sums[f])
                weights[f] = min(-shrunk / ((1 + math.sqrt(grown)) / step + l2), 0.0)
            moved = [t + 0.02 * min(max(m, -5.0), 5.0) + 1e-3 * k for k, (t, m) in enumerate(zip(thresholds, moves))]
            thresholds = [max(moved[: k + 1]) for k in range(len(moved))]
    return weights, thresholds


def test_grades_equal_those_of_a_plain_fit(spark):
    """Fit and scores of the query, document by document."""
    texts = dict(samples.table_rows(SF_DIR, "documents", "doc_id, text"))
    labels = samples.table_rows(SF_DIR, "labels", "doc_id, quality, toxic")
    rated = sorted(
        (doc, 0 if q == 0 else 1 if t == 1 else 2) for doc, q, t in labels if texts.get(doc) is not None and (q == 0 or t is not None)
    )
    tokens = {doc: {quality.hashed(t) for t in quality.tokens_of(text or "")} for doc, text in texts.items()}
    weights, thresholds = plain_fit([(tokens[doc], grade) for doc, grade in rated], 3)
    got = {r["doc_id"]: r for r in QUERIES["op5_ordinal_quality"](spark, SF_DIR).collect()}
    assert set(got) == set(texts) and any(weights.values())
    for doc, text in texts.items():
        score = sum(weights.get(quality.hashed(t), 0.0) for t in sorted(quality.tokens_of(text or "")))
        tails = [1 - 1 / (1 + math.exp(-(t - score))) for t in thresholds]
        assert got[doc]["expected_grade"] == pytest.approx(sum(tails), abs=1e-5), doc
        assert got[doc]["p_best"] == pytest.approx(tails[1], abs=1e-5) and got[doc]["kept"] == (round(tails[1], 6) >= 0.8)


def test_the_sample_is_the_same_in_every_run(spark):
    """Also where an id has many texts, more than the sample holds."""
    docs = spark.createDataFrame([(n % 7, f"text number {n} " + "good " * (n % 5) + "bad " * (n % 3)) for n in range(300)], "doc_id long, text string")
    ratings = spark.createDataFrame([(n, n % 2) for n in range(7)], "doc_id long, grade int")
    models = [quality.fit(docs.repartition(n), ratings, 2, sample=50) for n in (1, 5)]
    assert models[0].weights == models[1].weights and (models[0].thresholds == models[1].thresholds).all()


def nearest(vectors, k=20, every=20):
    ids = np.array([i for i, _ in vectors])
    matrix = np.array([v for _, v in vectors], dtype=float)
    out = set()
    for i, q in vectors:
        if i % every == 0:
            scores = matrix @ np.array(q, dtype=float)
            order = [j for j in np.lexsort((ids, -np.round(scores, 12))) if ids[j] != i][:k]
            out |= {(i, n + 1, int(ids[j])) for n, j in enumerate(order)}
    return out


def test_recall(spark):
    got = {tuple(r)[:3] for r in QUERIES["op8_projected_neighbours"](spark, "/root/testdata/sf0.01").collect()}
    expected = nearest(samples.table_rows("/root/testdata/sf0.01", "embeddings", "vec_id, embedding"))
    assert len(got) == len(expected)
    assert len({(q, i) for q, _, i in got} & {(q, i) for q, _, i in expected}) >= 0.9 * len(expected)


def test_neighbours_in_many_cells(spark, monkeypatch):
    for name, value in (("CELL_ROWS", 128), ("LEAF_ROWS", 16), ("QUERY_ROWS", 16)):
        monkeypatch.setattr(near, name, value)
    random = np.random.default_rng(5)
    centres = random.standard_normal((12, 16))
    vectors = [(n, (centres[n % 12] * (1 + n % 3) + random.standard_normal(16) * 0.4).tolist()) for n in range(1500)]
    got = near.neighbours(spark.createDataFrame(vectors, "id long, vector array<double>"))
    found = {(r["query_id"], r["id"]) for r in got.collect()}
    expected = {(q, i) for q, _, i in nearest(vectors)}
    assert len(found & expected) >= 0.9 * len(expected)


def test_rows_are_copied_only_where_many_queries_meet(spark, monkeypatch):
    for name, value in (("CELL_ROWS", 64), ("QUERY_ROWS", 256)):
        monkeypatch.setattr(near, name, value)
    routed, stored = [], near.materialise
    monkeypatch.setattr(near, "materialise", lambda df: routed.append(stored(df)) or routed[-1])
    random = np.random.default_rng(8)
    vectors = [(n, random.standard_normal(8).tolist()) for n in range(1024)]
    near.neighbours(spark.createDataFrame(vectors, "id long, vector array<double>"), k=3, every=2)
    at_home = [df for df in routed if "block" in df.columns][0]
    per_block = at_home.groupBy("cell", "block").count()
    assert at_home.count() == 512 > near.QUERY_ROWS
    assert per_block.agg({"count": "max"}).first()[0] <= near.QUERY_ROWS


def test_awkward_vectors(spark):
    good = [(n, [float(n % 5), 1.0, 0.5]) for n in range(30)] + [(60, [4.0, 1.0, 0.5])]
    bad = [(100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, None, 0.0]), (160, [math.nan, 1.0, 0.0]), (180, [math.inf, 1.0, 0.0]),
           (200, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (0, [0.0, 1.0, 0.5])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in good + bad], "id long, vector array<double>, name string, cell int")
    got = near.neighbours(frame)
    assert {tuple(r)[:3] for r in got.collect()} == nearest(good)
    few = near.neighbours(frame.where("id < 3"))
    assert rows(few, "query_id", "rank", "id") == [(0, 1, 1), (0, 2, 2)]
    assert near.neighbours(frame.where("false")).count() == 0
