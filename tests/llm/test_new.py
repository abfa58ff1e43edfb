"""Main text, collocations and periodic runs: against brute force, labelled pages and odd rows."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from compare import difference, duckdb_on, oracle_rows, spark_rows
from pyspark.sql import functions as F

from tallyfold.llm import collocations, decontamination, line_quality, main_text, oracle, periodic_runs, secrets, sharding
from tallyfold.llm.common import table
from tallyfold.llm.queries import llm_queries

LONG = " ".join(f"w{i % 997} x{i}" for i in range(60_000))


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs in every column, empty and very long texts, repeated rows, clashing columns."""
    extra = (1, "s", 7, 3, "p", 4)
    rows = [
        (None, None, None, None, None),
        (1, None, "en", "a", 0),
        (2, "", None, "a", 0),
        (3, " \n\t ", None, "a", 4),
        (4, LONG, "en", "b", len(LONG)),
        (5, "one two " * 40, "en", None, None),
        (5, "one two " * 40, "en", None, None),
        (None, "one two " * 40, None, "b", 1),
        (6, "A\tb  c. A\x0bb c; a b, c", "en", "b", 5),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, w1 int, phrase string, start int, n int, ws string, l int"
    return spark.createDataFrame([row + extra for row in rows], schema)


# Periodic runs


def _runs_by_brute_force(words):
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smallest = all(any(words[x] != words[x + d] for x in range(i, i + length - d)) for d in range(1, q))
            if length >= max(24, 3 * q) and smallest:
                found.append((i, length, q))
            i = j
    return sorted(found, key=lambda run: (run[0], run[2]))


def _random_words(rng):
    words = []
    while len(words) < rng.choice([20, 100, 300]):
        block = [rng.choice("abc") for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.4:
            block = block * 2 + block[: rng.randint(0, len(block))]
        kind = rng.random()
        if kind < 0.4:
            words += [rng.choice("ab") for _ in range(rng.randint(1, 30))]
        elif kind < 0.8:
            words += (block * 9)[: rng.randint(len(block), 7 * len(block))]
        else:
            words += [rng.choice("ab")] * rng.randint(1, 60)
    return words


def test_runs_as_by_brute_force():
    rng = random.Random(3)
    total = 0
    for _ in range(150):
        texts = [_random_words(rng) for _ in range(3)]
        expected = [_runs_by_brute_force(words) for words in texts]
        assert periodic_runs.runs_of(texts) == expected
        total += sum(map(len, expected))
    assert total > 200


def test_runs_of_long_periodic_texts():
    assert periodic_runs.runs_of([["a"] * 300_000, [], ["a", "b", "a", "c"] * 50_000]) == [[(0, 300_000, 1)], [], [(0, 200_000, 4)]]


def test_periodic_runs_query(spark, folder):
    rows = {r.doc_id: r for r in llm_queries()["op13_periodic_runs"](spark, folder).collect()}
    docs = table(spark, folder, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        words = periodic_runs.made_periodic(doc.doc_id, re.findall(r"[^\x20\x09-\x0D]+", doc.text or ""))
        if len(words) > 1500:
            continue
        runs, row = _runs_by_brute_force(words), rows[doc.doc_id]
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
        texts = "".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(kept)
        assert (row.runs_sha256, row.collapsed_sha256) == tuple(hashlib.sha256(t.encode()).hexdigest() for t in texts)
        assert row.n_runs == len(runs)
        if runs:
            s, n, q = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (s, n, q, 1000 * n // q)
    assert sum(row.n_runs > 0 for row in rows.values()) > len(rows) // 20


def test_periodic_runs_of_odd_rows(odd):
    rows = periodic_runs.periodic_runs(odd).collect()
    assert len(rows) == 9
    empty = hashlib.sha256(b"").hexdigest()
    found = {(r.doc_id, r.n_runs, r.start, r.length, r.period) for r in rows}
    assert {(5, 1, 0, 80, 2), (None, 1, 0, 80, 2), (None, 0, None, None, None), (2, 0, None, None, None)} <= found
    assert all(r.collapsed_sha256 == empty and r.runs_sha256 == empty for r in rows if r.doc_id in (1, 2, 3))
    assert periodic_runs.periodic_runs(odd.filter("false")).count() == 0


# Collocations


def test_collocations_match_oracle(spark):
    folder = "/root/testdata/sf0.01"
    found = spark_rows(llm_queries()["op12_collocations"](spark, folder))
    assert difference(found, oracle_rows(duckdb_on(folder), oracle.COLLOCATIONS)) is None


def test_collocations_of_odd_rows(odd):
    rows = {(r.lang, r.phrase): r for r in collocations.collocations(odd).collect()}
    # Four documents of 80 words, two of them in no language.
    assert {lang for lang, _ in rows} == {"en", "und"}
    triple = rows["en", "one two one"]
    assert (triple.a, triple.l, triple.r, triple.score) == (78, 80, 80, 950_625)  # the second cut is lower
    assert ("en", "one two") not in rows and ("und", "two one") not in rows  # inside longer ones as frequent
    assert rows["und", "one two one"].a == 39 and triple.n == 160 + 120_000 + 9
    assert collocations.collocations(odd.filter("false")).count() == 0


def test_collocations_do_not_depend_on_the_bitmap(spark, folder, monkeypatch):
    docs = table(spark, folder, "documents")
    expected = Counter(map(tuple, collocations.collocations(docs).collect()))
    monkeypatch.setattr(collocations, "MAP_BITS", 8)  # every bit is set
    assert Counter(map(tuple, collocations.collocations(docs).collect())) == expected and expected


def test_collocations_of_four_words(spark):
    text = "the one the only way, " * 12 + "one only " * 30
    docs = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    rows = {r.phrase: r for r in collocations.collocations(docs, longest=4).collect()}
    best = rows["the one the only"]
    assert (best.a, best.l, best.r, best.score) == (12, 12, 42, 285_714)
    assert "one the only" not in rows  # inside a longer one as frequent


# Main text

PAGES = [
    (
        '<!doctype html><html><head><title>T</title></head><body class="has-sidebar"><header class="site-header"><h1>Site</h1><nav><a href=/>Home</a>'
        '</nav></header><div id="cookie-banner">We use cookies to make this site better. <button>OK</button></div><div class="content">'
        "<h2>Big storm hits coast</h2><p>A big storm hit the coast on Monday, leaving many homes without power and roads closed.</p>"
        '<div class="ad-slot">Buy now! Best offers for you today only.</div><p>Officials said   repairs would <b>take</b> days&nbsp;&amp; asked people'
        "\n to stay home.</p><ul><li>Stay inside<li>Keep water ready</ul><p>More soon.</p></div><aside><h3>Related</h3><a>Story one</a></aside>"
        '<section id="comments"><article class="comment"><p>I saw it happen, it was a terrible storm and the worst in years.</p></article>'
        "<form><textarea>say</textarea></form></section><footer>&copy; 2020 Site</footer></body></html>",
        "Big storm hits coast\nA big storm hit the coast on Monday, leaving many homes without power and roads closed.\n"
        "Officials said repairs would take days & asked people to stay home.\nStay inside\nKeep water ready\nMore soon.",
    ),
    (
        "<body><form id=f><div class=menu><a>x</a><a>y</a></div><table><tr><td><h1>Title</h1><p>Long enough paragraph text, which has a number of"
        " words in it.<p>Second one is here, too, with words.</td></tr></table></form>",
        "Title\nLong enough paragraph text, which has a number of words in it.\nSecond one is here, too, with words.",
    ),
    (
        "<main><article><header><h1>Head</h1><p>By me</p></header><p>Short.</p><aside>side text here</aside><p>End.</p></article></main>",
        "Head\nBy me\nShort.\nEnd.",
    ),
    ("plain text without tags, as it is, in some words.", "plain text without tags, as it is, in some words."),
    ("<div>3 < 4 and 5 > 2 in one text with more words in it.</div><script>'<p>no</p>'</script><!-- <p>gone</p> -->", "3 < 4 and 5 > 2 in one text with more words in it."),
    ("<nav><a>a</a></nav><footer>f</footer>", ""),
    ("", ""),
    (None, ""),
    ("<p>Some words in one text, cut off in a tag. <a href='x", "Some words in one text, cut off in a tag."),
    ("<article><p>Some words in a text.</p><div hidden>none</div><p>And <i>more</i>b", "Some words in a text.\nAnd moreb"),
]


def _article(page):
    """Blocks of the article as the test tables build it."""
    body = re.search(r"<article>(.*)</article>", page, re.DOTALL).group(1)
    parts = re.split(r"</?p>|</?h1>|<br>", body)
    return "\n".join(filter(None, (" ".join(main_text.html.unescape(re.sub("<[^>]*>", "", part)).split()) for part in parts)))


@pytest.fixture(scope="module")
def weights(spark, folder):
    return main_text.learned_weights(table(spark, folder, "pages"))


def test_main_text_of_pages_written_for_it(weights):
    assert [main_text.extract(page or "", weights) for page, _ in PAGES] == [text for _, text in PAGES]


def test_main_text_of_held_out_pages_without_their_mark(spark, weights):
    pages = [r.html for r in table(spark, "/root/testdata/sf0.01", "pages").collect()]
    bare = [re.sub("(</?)(article|nav|footer)", r"\1div", page) for page in pages]
    right = sum(main_text.extract(page, weights) == _article(whole) for page, whole in zip(bare, pages, strict=True))
    assert right >= 0.95 * len(pages)
    assert all(main_text.extract(page, weights) == _article(page) for page in pages)


def test_weights_are_learned(weights):
    """Places of the labelled articles weigh more than the pseudo-counts alone give them."""
    alone = main_text.weights_from({})
    assert weights["at:p"] > 1 > 0 > weights["at:menu"] and weights["at:h1"] > alone["at:h1"]


def test_greatest_region_is_that_of_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        scores = [rng.choice([-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 3.0]) for _ in range(rng.randint(0, 12))]
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
        first, end = main_text.region(scores)
        assert sum(scores[first:end]) == max([0.0, *sums])


def test_main_texts_of_odd_rows(spark, folder):
    rows = [(None, None, None), (1, "u", None), (1, "u", ""), (2, None, "<p>Some words, a text. " * 20_000), (2, None, "<p>Some words, a text. " * 20_000)]
    pages = spark.createDataFrame([(*row, "x", 5) for row in rows], "page_id long, url string, html string, text string, n_chars int")
    found = main_text.main_texts(pages).collect()
    assert sorted(r.n_chars for r in found) == [0, 0, 0, 399_999, 399_999]  # 20,000 blocks of 19 characters, joined by line feeds
    assert main_text.main_texts(pages.filter("false")).count() == 0
    assert found[0].__fields__ == ["page_id", "url", "text", "n_chars"]


def test_main_texts_query(spark, folder):
    found = {r.page_id: r for r in llm_queries()["op11_main_text"](spark, folder).collect()}
    pages = table(spark, folder, "pages").collect()
    assert {p.page_id: _article(p.html) for p in pages} == {i: r.text for i, r in found.items()}
    assert all(r.n_chars == len(r.text) for r in found.values())


@pytest.mark.parametrize("page", ["<p>" * 40_000 + "x", '<a "' * 100_000, "<div><b>x" * 20_000, "<!-- <script>" * 50_000, "<p><td>x" * 20_000, "<" * 200_000])
def test_long_broken_pages_end(weights, page):
    assert isinstance(main_text.extract(page, weights), str)


def test_main_texts_keep_pages_with_equal_ids(spark, folder):
    pages = table(spark, folder, "pages")
    assert main_text.main_texts(pages.union(pages)).groupBy("page_id").agg(F.expr("count(*) as n")).filter("n <> 2").count() == 0


# Decontamination: one plan at every size


def _hits_by_brute_force(text, items):
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    words = split(text.translate({c: c + 32 for c in range(65, 91)}))
    covered, found = set(), set()
    for item_id, item in items:
        own = split(item.lower())
        n = min(10, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                covered |= set(range(i, i + n))
                found.add(str(item_id))
    return len(words), len(covered), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


@pytest.mark.parametrize("threshold", ["-1", "1g"])
def test_items_of_all_lengths_together(spark, threshold):
    rng = random.Random(7)
    items = [(n, " ".join(rng.choice("abcdef") for _ in range(n))) for n in range(1, 13)] + [(13, ""), (14, None)]
    items = [(i, text if i != 1 else "rare") for i, text in items]  # one letter would hit every text
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 400))) for _ in range(40)]
    texts += [f"x y {items[n][1]} Z {items[n][1].upper()}" for n in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = decontamination.decontaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
        rows = {r.doc_id: (r.n_words, r.n_hit, r.items_sha256) for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    listed = [(i, text or "") for i, text in items]
    assert rows == {i: _hits_by_brute_force(text, listed) for i, text in enumerate(texts)}


def test_texts_are_exchanged_alike_at_every_size(spark, folder):
    """The same joins of texts under any broadcast threshold; two scans of texts."""
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    plans = []
    for threshold in ("-1", "1g"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            plan = decontamination.decontaminated(docs, benchmark)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert plan.count("documents.parquet") == 2
        plans.append(re.findall(r"(\w+Join) \[(?:coalesce\()?(?:id|doc_id)#", plan))
    assert plans[0] == plans[1] == ["SortMergeJoin"] * 2


# Secrets


def _base_spans_by_regex(text):
    found = {"assign": [], "access": [], "hex": []}
    for m in re.finditer(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.ASCII):
        if len(m[1]) >= 6:
            found["assign"].append(m.span())
    found["access"] = [m.span() for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    found["hex"] = [m.span() for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return found


def test_base_spans_as_by_regex(spark):
    rng = random.Random(4)
    kinds = ["token = {}", "PassWord:'{}'", "api_key=\"{}", "{}", "AKIA{}", "é{}ß", "x/{}-{}", "secret:: {}"]
    alphabets = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghij", "01"]

    def word():
        letters = rng.choice(alphabets)
        return "".join(rng.choice(letters) for _ in range(rng.randint(3, 44)))

    texts = [rng.choice([" ", "\n", ""]).join(rng.choice(kinds).format(word(), word()) for _ in range(rng.choice([0, 1, 127, 128, 129, 400]))) for _ in range(40)]
    rows = secrets.secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(rows) == len(texts)
    for row in rows:
        expected = _base_spans_by_regex(texts[row.doc_id])
        assert {kind: [tuple(c) for c in row[kind]] for kind in expected} == expected


def test_many_matches_in_one_text_take_time_in_proportion(spark):
    rng = random.Random(6)
    text = "é " + " ".join("".join(rng.choice("0123456789abcdef") for _ in range(32)) for _ in range(40_000))
    started = time.monotonic()
    row = secrets.digest(secrets.secrets(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert row.n_hex == 40_000 and row.n_random > 39_000 and time.monotonic() - started < 100  # minutes before, without an end


def test_a_part_is_not_reported_beside_its_whole(spark):
    rng = random.Random(8)

    def key(n):
        return "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))

    texts = [f"see {key(40)}/{key(40)} end", f"see the-long-path-of-words-and-words/of-many-parts-in-it/{key(48)} end"]
    rows = {r.doc_id: [tuple(c) for c in r.random] for r in secrets.secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert rows[0] == [(4, 85)]
    assert len(rows[1]) == 1 and rows[1][0][1] == len(texts[1]) - 4  # the whole or its last part, not both


# Shards


def test_an_existing_map_is_read_and_followed(spark, folder, tmp_path):
    docs, path = table(spark, folder, "documents"), f"{tmp_path}/map"
    first = {r.doc_id: (r.shard, r.slot) for r in sharding.shard(docs, map_path=path).collect()}
    again = sharding.shard(docs, map_path=path).collect()
    assert len(again) == docs.count() and {r.doc_id: (r.shard, r.slot) for r in again} == first
    assert sharding.sharded_documents(docs, map_path=path).count() == docs.count()
    # A new version that empties shard 3 holds for the next call.
    edited = sharding.load_map(spark, path).selectExpr("version + 1 as version", "virtual_slot", "if(shard = 3, 4, shard) as shard")
    sharding.save_map(edited, path)
    moved = {r.doc_id: r.shard for r in sharding.shard(docs, map_path=path).collect()}
    assert moved == {i: 4 if s == 3 else s for i, (s, _) in first.items()}
    sharding.save_map(edited, path)
    with pytest.raises(ValueError, match="slots"):
        sharding.load_map(spark, path)


# Quality rules


def test_limits_are_shares_of_the_host(spark):
    """Passages that repeat on a host go from all documents but one; ordinary short lines of a large host stay."""
    rng = random.Random(9)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))

    passage, greeting, banner = prose(60), prose(4), prose(5)
    rows = []
    for i in range(2000):
        lines = [prose(70)]
        if i % 25 == 0:
            lines.append(greeting)  # short, in 4 % of the documents: stays
        if i % 10 == 1:
            lines.append(banner)  # short, in 10 %: goes
        if i % 200 == 7:
            lines.append(passage)  # long, in 0.5 %: goes
        rows.append((i, "\n".join(lines), "large"))
    rows += [(3000 + i, "\n".join([prose(70), passage] if i < 4 else [prose(70)]), "small") for i in range(30)]  # four documents: stays
    rows += [(4000 + i, f"{prose(20)}\n{passage}", "mirror") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in line_quality.line_quality(docs).collect()}
    lost = {i: r.n_words - r.n_left for i, r in found.items()}
    assert all(lost[i] == 5 for i in range(2000) if i % 10 == 1 and i > 1) and lost[1] == 0
    assert all(lost[i] == 60 for i in range(2000) if i % 200 == 7 and i > 7) and lost[7] == 0
    assert all(lost[i] == 0 for i in range(2000) if i % 10 != 1 and i % 200 != 7)
    assert all(lost[3000 + i] == 0 for i in range(30))
    # Documents that consist of the passage are rejected, all but the first.
    assert [found[4000 + i].kept for i in range(6)] == [True] + [False] * 5
    assert not any(found[4000 + i].base_failed for i in range(6))
    assert sum(r.kept for i, r in found.items() if i < 4000) == 2030


def test_line_limits_show_on_given_data(spark):
    found = line_quality.line_quality(table(spark, "/root/testdata/sf0.1", "documents"))
    assert found.filter("n_left < n_words").count() > 100
