import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontamination, pivot_index, quotations, style_tree
from millrace.llm.graph import components


def linked(rows, threshold=0.9):
    """Links and smallest reachable id by comparing everything with everything."""
    width = Counter(len(v) for _, v in rows if v).most_common(1)[0][0]
    good = [v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = np.array([v if ok else [0.0] * width for (_, v), ok in zip(rows, good)], dtype=float)
    unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-300)
    link = unit @ unit.T >= threshold
    np.fill_diagonal(link, False)
    ids = np.array([i for i, _ in rows])
    label = ids.copy()
    while True:
        lower = np.minimum(label, np.where(link, label[None, :], 2**60).min(axis=1))
        if (lower == label).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, link.sum(axis=1), label)}
        label = lower


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(1)
    rows = []
    for center in rng.normal(size=(120, 64)):
        center /= np.linalg.norm(center)
        for cosine in (1.0, 1.0, *rng.uniform(0.85, 1.0, 3)):
            other = rng.normal(size=64)
            other -= other @ center * center
            rows.append((cosine * center + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)).tolist())
    rows += [rows[0]] * 30 + [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63]
    return [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


def test_vector_links_against_brute_force(spark, vectors):
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("copies", F.lit("x"))
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in pivot_index.near_duplicates(table).collect()}
    expected = linked(vectors)
    assert found.keys() == expected.keys()
    assert all(found[i][0] <= n for i, (n, _) in expected.items())
    assert sum(f[0] for f in found.values()) >= 0.97 * sum(n for n, _ in expected.values())
    assert sum(found[i][1] == c for i, (_, c) in expected.items()) >= 0.97 * len(found)
    assert all(kept == (i == component) for i, (_, component, kept) in found.items())


def test_vector_lists_in_blocks_count_the_same(spark, vectors, monkeypatch):
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    whole = sorted(map(tuple, pivot_index.near_duplicates(table).collect()))
    monkeypatch.setattr(pivot_index, "BLOCK", 4)
    described = pivot_index.links.__defaults__
    monkeypatch.setattr(pivot_index.links, "__defaults__", (4,))
    assert described and sorted(map(tuple, pivot_index.near_duplicates(table).collect())) == whole


def test_no_vectors(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pivot_index.near_duplicates(table).collect() == []
    alone = spark.createDataFrame([(5, [1.0, 0.0]), (None, [1.0, 0.0]), (6, [1.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in pivot_index.near_duplicates(alone).collect() if r["vec_id"]) == [(5, 0, 5, True), (6, 0, 6, True)]


def test_components_against_search(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(60)] + [(7, None), (9, 9)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if b is not None and a != b:
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == sorted((x, top(x)) for x in root)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_blocks_of_a_page():
    texts = lambda page: [text for _, _, text in style_tree.blocks(page)]
    assert texts("<p>a<b>b</b>c &amp; d<br>e</p><div>x <span class='ad'>buy</span> y</div><nav>menu</nav>tail") == ["abc & d e", "x y", "tail"]
    page = """<body class=has-sidebar><header>H</header><main><h1>T &eacute;</h1><article><p>one<p>two <i>three
      </article></main><div id="comments"><p>bad</div><aside>no</aside><footer>f</footer>"""
    assert texts(page) == ["T é", "one", "two three"]
    assert texts("<article><p>x<script>if(a<b)</script>y<!-- c --></p><form>f<input></form><ul><li>1<li>2</ul><table><tr><td>a<td>b</table>") == ["xy", "1", "2", "a", "b"]
    assert texts("<title>t</title><style>p{}</style>plain 1 < 2 <3") == ["plain 1 < 2 <3"]
    assert texts("<div class='cookie-notice'>c</div><p hidden>h</p><div role=search>s</div><p>kept</p></div></p>") == ["kept"]
    assert texts(None) == texts("") == texts("<!-- open") == texts("<script>never closed <p>x") == []
    assert texts("<p>" + "long " * 50_000) == [("long " * 50_000).strip()]


def test_branches_that_come_back_on_every_page_go(spark):
    words = [f"word{i}" for i in range(50)]
    rng = random.Random(3)
    row = lambda host, i, extra="": (
        i, host and f"http://{host}/{i}", f"<div class=top>Same on all</div><div class=text>{' '.join(rng.sample(words, 8))}</div>{extra}"
    )
    pages = [row("a.example", i) for i in range(30)] + [row("B.example", 100 + i) for i in range(4)] + [row(None, 200), (201, "", None), (None, "x", "")]
    found = {r["page_id"]: r["text"] for r in style_tree.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert len(found) == len(pages)
    assert all("Same" not in found[i] and "word" in found[i] for i in range(30))
    assert all("Same" in found[100 + i] for i in range(4)) and found[201] == found[None] == ""
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert style_tree.main_text(none).collect() == []


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").lower())
    return [tuple(words[k : k + 5]) for k in range(len(words) - 4)] if len(words) >= 5 else ([tuple(words)] if words else [])


def best_windows(docs, items, least=0.75):
    """Highest Jaccard similarity of shingles with their numbers, over every window of every document with every item."""
    parts = {i: shingles(text) for i, text in items}
    found = {}
    for doc, text in docs:
        grams = shingles(text)
        for i, part in parts.items():
            one = Counter(part)
            for start in range(max(len(grams) - len(part), 0) + 1) if part and grams else ():
                window = Counter(grams[start : start + len(part)])
                both = sum((window & one).values())
                value = both / sum((window | one).values())
                if value >= max(least, found.get((doc, i), 0)):
                    found[doc, i] = value
    return found


@pytest.mark.parametrize("ids", [1, 2, 4, 8])
def test_an_item_under_many_ids_is_found_with_a_word_changed(spark, docs_of, ids):
    rng = random.Random(ids)
    words = [f"t{i}" for i in range(300)]
    passage = rng.choices(words, k=44)
    docs = []
    for i in range(30):
        changed = list(passage)
        changed[rng.randrange(5, 39)] = "changed"
        docs.append((i, " ".join(rng.choices(words, k=rng.randrange(60)) + changed + rng.choices(words, k=rng.randrange(60)))))
    items = [(i, " ".join(passage)) for i in range(ids)] + [(100, " ".join(passage[20:] + rng.choices(words, k=20)))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs_of(docs), benchmark).collect()}
    assert found >= {(d, i) for d in range(30) for i in range(ids)}
    assert found == set(best_windows(docs, items))


def test_contaminated_against_all_windows(spark, docs_of):
    rng = random.Random(6)
    words = [f"t{i}" for i in range(300)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(text(rng.randrange(15, 58)))) for i in range(25)] + [(100, "two words"), (101, ""), (102, None), (None, "x y z a b c")]
    items.append((103, items[0][1] + " " + items[1][1]))
    docs = [(i, " ".join(text(rng.randrange(0, 200)))) for i in range(60)]
    for i in range(25):
        passage = items[i][1].split()
        for _ in range(rng.randrange(3)):
            passage[rng.randrange(len(passage))] = "changed"
        docs.append((1000 + i, " ".join(text(rng.randrange(80)) + passage + text(rng.randrange(80))).upper()))
    docs += [(2000, "Two  words"), (2001, "two words more"), (2002, None), (2003, ""), (None, items[3][1]), (2004, "long " * 30_000 + items[5][1])]
    table = docs_of(docs).withColumn("shingles", F.lit("x")).withColumn("bad_id", F.lit(1))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontamination.contaminated(table, benchmark).collect()}
    expected = best_windows([d for d in docs if d[0] not in (None, 2004)], [i for i in items if i[0] is not None])
    assert found.pop((2004, 5)) == 1.0
    assert found == pytest.approx(expected)
    clean = decontamination.without_contaminated(table, benchmark)
    assert clean.columns == table.columns
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in expected} - {2004}
    assert decontamination.contaminated(table.limit(0), benchmark).collect() == []
    assert decontamination.contaminated(table, benchmark.limit(0)).collect() == []


def test_contaminated_with_repeated_rows(spark, docs_of):
    passage, other = (" ".join(f"{name}{i}" for i in range(30)) for name in "pq")
    items = [(1, passage), (1, passage), (2, other), (2, "quite another text that no document has at all")]
    docs = [(10, f"before {passage} after"), (10, f"before {passage} after"), (11, other), (11, "short"), (12, other), (12, f"{passage} {other}")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((r["doc_id"], r["item_id"], r["similarity"]) for r in decontamination.contaminated(docs_of(docs), benchmark).collect())
    assert found == [(10, 1, 1.0), (11, 2, 1.0), (12, 1, 1.0), (12, 2, 1.0)]
    assert decontamination.without_contaminated(docs_of(docs), benchmark).collect() == []


def test_every_fingerprint_within_the_radius_shares_a_block(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(300):
        one = rng.getrandbits(64)
        other = one
        for bit in rng.sample(range(64), rng.randrange(decontamination.RADIUS + 1)):
            other ^= 1 << bit
        rows.append((one - 2**63, other - 2**63))
    table = spark.createDataFrame(rows, "a long, b long")
    shared = F.arrays_overlap(decontamination.blocks("a", decontamination.RADIUS), decontamination.blocks("b", decontamination.RADIUS))
    assert table.filter(~shared).count() == 0


def test_replies_from_quotations(spark):
    rows = [
        (1, 0, "user", "Hello there.\n\nHow are you?"), (1, 1, "assistant", "On Monday user wrote:\n> How  are\n> YOU?\n\nFine, thanks."),
        (1, 2, "user", "> Fine, thanks.\n>> how are you?\nGood!"), (1, 3, "user", "New topic"), (1, 3, "user", "New topic"),
        (1, 4, "a", "> unknown words\nreply"), (1, 5, "u", "> New topic\n\n> Good!\nok"), (2, 0, "u", "> Hello there.\nx"),
        (2, None, "u", "y"), (None, 0, "u", None), (1, 6, None, "> " * 40 + "deep\nlast"), (1, 7, "u", "z " * 60_000),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("lines", F.lit(1)).withColumn("root", F.lit(2))
    found = {(r["conv_id"], r["turn"]): r for r in quotations.reply_ordered(table).collect()}
    assert len(found) == len(rows) - 1
    place = {key: (r["root"], r["depth"], r["reply_to"], r["text"]) for key, r in found.items() if key != (1, 7)}
    assert place[1, 1] == (0, 1, 0, "Fine, thanks.")
    assert place[1, 2] == (0, 2, 1, "Good!")
    assert place[1, 5] == (3, 1, 3, "ok")
    assert place[1, 4] == (4, 0, None, "reply") and place[2, 0] == (0, 0, None, "x")
    assert place[None, 0] == (0, 0, None, "") and place[2, None] == (None, 0, None, "y")
    assert found[1, 6]["deepest"] == 40 and found[1, 6]["text"] == "last"
    assert quotations.reply_ordered(table.limit(0)).collect() == []


def test_deep_threads(spark):
    rows = [(1, i, "u", f"> text {i - 1}\n\ntext {i}" if i else "text 0") for i in range(40)]
    found = quotations.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r["turn"], r["root"], r["depth"]) for r in found) == [(i, 0, i) for i in range(40)]


def test_deeper_quotations_link_where_no_first_level_is_found(spark):
    messages = spark.createDataFrame(
        [
            (1, 0, "a", "alpha beta"), (1, 1, "b", "> alpha beta\n\ngamma"), (1, 2, "a", ">> alpha beta\n\nonly the inner one"),
            (1, 3, "b", "> gamma\n>> alpha beta\n\nfirst level wins"), (1, 4, "a", "> never written\n>>> gamma\n\nthird level"), (1, 5, "c", ">> nowhere"),
            (2, 0, "a", ">> alpha beta"),
        ],
        "conv_id long, turn long, role string, text string",
    )
    found = {(r["conv_id"], r["turn"]): (r["reply_to"], r["root"], r["quoted"], r["linked"], r["text"]) for r in quotations.reply_ordered(messages).collect()}
    assert found[1, 1] == (0, 0, 1, 1, "gamma")
    assert found[1, 2] == (0, 0, 0, 1, "only the inner one")
    assert found[1, 3] == (1, 0, 1, 1, "first level wins")
    assert found[1, 4] == (1, 0, 1, 1, "third level")
    assert found[1, 5][:4] == (None, 5, 0, 0) and found[2, 0][:4] == (None, 0, 0, 0)


def test_links_of_random_quotations_against_a_search(spark):
    """Every message quotes some earlier ones at random levels; a plain search over all messages finds the replies."""
    rng = random.Random(8)
    rows, own = [], {}
    for conv in range(6):
        for turn in range(25):
            quoted = {level: rng.sample(range(turn), min(turn, rng.randrange(3))) for level in (1, 2, 3) if rng.random() < 0.6}
            lines = [f"{'>' * level} text {conv} {source if rng.random() < 0.8 else 'gone'}\n{'>' * level}" for level, sources in quoted.items() for source in sources]
            own[conv, turn] = f"text {conv} {turn}"
            rows.append((conv, turn, "a", "\n\n".join([*lines, own[conv, turn]])))
    found = {(r["conv_id"], r["turn"]): r["reply_to"] for r in quotations.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    for conv, turn, _, text in rows:
        expected = None
        for level in (1, 2, 3):
            marked = {line[level:].strip() for line in text.split("\n") if re.match(rf">{{{level}}}[^>]", line)}
            sources = [t for t in range(turn) if own[conv, t] in marked]
            if sources:
                expected = max(sources)  # each is quoted once, the last of equals counts
                break
        assert found[conv, turn] == expected
