"""Operators over many documents: packing, near duplicates, repeated spans, decontamination, page differencing, the pipeline."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loanweave.llm import components, decontamination, html_extraction, near_duplicates, packing, repeated_spans

from .fixtures import awkward, frame, prose, rows_of


def check_packing(rows, packed, capacity=2048):
    encode = packing.Encoder(packing.Vocabulary.public()).whole.encode
    want = sorted((d, *c) for d, t, *_ in rows for c in packing.cut(np.array(encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == want
    bins = defaultdict(list)
    for r in packed:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(spark, monkeypatch):
    rows = [(-1 if d is None else d, *r) for d, *r in awkward()]
    odd = ["a  b", " a", "a ", "a\n b\tc", "<|endoftext|> x", "it's 12 €5 日本", "x" * 3000, "a\u00a0 b"]
    rows += [(100 + i, t, None, None, None) for i, t in enumerate(odd)] + [(200 + i, prose(i, 30 + 7 * i), None, None, None) for i in range(60)]
    monkeypatch.setattr(packing, "BINS_PER_TASK", 8)
    packed = packing.pack(frame(spark, rows, extra=True).repartition(5)).collect()
    used = check_packing(rows, packed)
    total = sum(r["length"] for r in packed)
    assert used <= -(-total // 2048) + 2
    assert {r["doc_id"] for r in packing.pack(frame(spark)).collect()} == {r[0] for r in awkward()}
    assert packing.pack(frame(spark, [])).count() == 0


def test_best_fit():
    rng = random.Random(2)
    lengths = [rng.randrange(1, 2048) for _ in range(500)]
    bins = packing.best_fit(lengths)
    assert sorted(i for b in bins for i in b) == list(range(500))
    assert max(sum(lengths[i] for i in b) for b in bins) <= 2048
    assert len(bins) <= 1.05 * sum(lengths) / 2048 + 1
    assert packing.best_fit([]) == []


def shingle_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(rows, per_cent=85):
    sets = [shingle_set(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= per_cent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    lowest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            lowest[find(i)] = min(r[0], lowest.get(find(i), r[0]))
    return sorted(((r[0], len(sets[i]), lowest.get(find(i)), r[0] == lowest.get(find(i))) for i, r in enumerate(rows)), key=repr)


def near_copies(seed, n, words, edits):
    rng, base = random.Random(seed), prose(seed, words).split()
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits)):
            copy[rng.randrange(words)] = f"w{rng.randrange(10**6)}"
        yield " ".join(copy)


@pytest.mark.parametrize("block", [4096, 16])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    texts = [*near_copies(1, 60, 150, 9), *near_copies(2, 30, 40, 3), *near_copies(3, 20, 400, 40), *(prose(50 + i, 90) for i in range(30))]
    texts += [prose(7, 60) + " " + prose(400 + i, 25) for i in range(40)] + [prose(1, 150).upper(), prose(1, 4), prose(1, 4)]
    rows = awkward() + [(1000 - i, t, None, None, None) for i, t in enumerate(texts)]
    got = near_duplicates.near_duplicates(frame(spark, rows, extra=True).repartition(4)).drop("row_key")
    assert rows_of(got) == brute_groups(rows)


@pytest.mark.parametrize("per_cent", [80, 85])
def test_near_duplicates_around_a_threshold(spark, monkeypatch, per_cent):
    """Copies of one text, most of them just linked with it or just not, some linked only through another copy."""
    made, compared = near_duplicates.cross_pairs, []

    def counted(*given):
        pairs = made(*given)
        compared.append(pairs.count())
        return pairs

    monkeypatch.setattr(near_duplicates, "cross_pairs", counted)
    rng = random.Random(per_cent)
    base = prose(3, 150).split()

    def edited(words, times, seed):
        words = list(words)
        for k in rng.sample(range(len(words)), times):
            words[k] = f"edit{seed}x{k}"
        return words

    texts = [base, *(edited(base, 2 + i % 5, i) for i in range(150))]
    texts += [edited(texts[i], 2, 1000 + i) for i in range(1, 150, 3)] + [t[: 130 + i] for i, t in enumerate(texts[5:20])]
    texts += [base[: 60 + 5 * i] + prose(900 + i, 90 - 5 * i).split() for i in range(15)]
    rows = [(1000 - i, " ".join(t), None, None, None) for i, t in enumerate(texts)]
    want = brute_groups(rows, per_cent)
    got = near_duplicates.near_duplicates(frame(spark, rows).repartition(4), per_cent).drop("row_key")
    assert rows_of(got) == want
    groups = len({r[2] for r in want})
    assert groups > 10 and sum(compared) < 20 * len(rows)


def test_near_duplicates_at_a_low_threshold(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate([*near_copies(4, 40, 80, 14), *(prose(i, 60) for i in range(10))])]
    got = near_duplicates.near_duplicates(frame(spark, rows).repartition(2), 50).drop("row_key")
    assert rows_of(got) == brute_groups(rows, 50)


@pytest.mark.parametrize("per_cent", [50, 80, 85, 90])
def test_least_shared_holds_for_sets_in_different_groups(per_cent):
    rng, seen = random.Random(per_cent), 0
    for _ in range(4000):
        head = set(range(rng.randrange(5, 60)))
        a = {x for x in head if rng.random() > 0.12} | set(range(100, 100 + rng.randrange(8)))
        b = {x for x in a if rng.random() > 0.06} | set(range(200, 200 + rng.randrange(4)))
        if not a or not b or 100 * len(a & b) < per_cent * len(a | b):
            continue
        linked = [100 * len(x & head) >= per_cent * len(x | head) for x in (a, b)]
        if all(linked):
            continue
        seen += 1
        shared = len((a ^ head) & (b ^ head))
        for x, near in zip((a, b), linked):
            assert shared >= near_duplicates.least_shared(len(x ^ head), len(x), len(head), near, per_cent)
        assert len(a & b) >= near_duplicates.least_shared(len(a), len(a), 0, False, per_cent)
    assert seen > 100


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates.near_duplicates(frame(spark, [])).count() == 0
    assert near_duplicates.one_of_each(frame(spark, [(1, None, *[None] * 3), (2, "", *[None] * 3)])).count() == 2


def test_one_of_each(spark):
    kept = near_duplicates.one_of_each(frame(spark, extra=True))
    assert kept.columns == frame(spark, extra=True).columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 3, 4, 5, 6, 7]
    clashing = near_duplicates.one_of_each(frame(spark).withColumn("_kept_key", F.lit("mine")))
    assert {r["_kept_key"] for r in clashing.collect()} == {"mine"}


def test_least_overlap_is_exact_for_small_sets():
    assert all(near_duplicates.least_overlap(n) == -(-85 * n // 100) for n in range(1, 54))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    labels = components.components(spark.createDataFrame(edges, "a long, b long"))
    want = {7: 7, **{i: 10 for i in range(10, 61)}, **{100 + i: 100 for i in range(40)}}
    assert dict(rows_of(labels.select("id", "label"))) == want


def brute_removed(rows):
    seen = defaultdict(int)
    data = [(r[0], (r[1] or "").encode()) for r in rows]
    for _, b in data:
        for p in range(len(b) - 199):
            seen[b[p : p + 200]] += 1
    out = []
    for doc_id, b in data:
        runs = []
        for p in range(len(b) - 199):
            if seen[b[p : p + 200]] > 1:
                if runs and p <= runs[-1][1]:
                    runs[-1][1] = p + 200
                else:
                    runs.append([p, p + 200])
        kept, at = b"", 0
        for s, e in runs:
            kept, at = kept + b[at:s], e
        kept += b[at:]
        out.append((doc_id, len(b), sum(e - s for s, e in runs), len(runs), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("piece,most", [(1 << 17, 1_000), (500, 2)])
def test_repeated_spans(spark, monkeypatch, piece, most):
    monkeypatch.setattr(repeated_spans, "PIECE", piece)
    monkeypatch.setattr(repeated_spans, "TASK_CONTEXTS", most)
    passage = "ä" + prose(70, 45)
    texts = [prose(i, 50) + " " + passage + " " + prose(100 + i, 50) for i in range(12)]
    texts += [prose(300, 40)[:199], prose(300, 40)[:199], prose(301, 40)[:200], prose(301, 40)[:200], "=" * 900, "ab" * 300, prose(2, 60) * 2]
    texts += list(near_copies(9, 10, 200, 6))
    rows = awkward() + [(1000 + i, t, None, None, None) for i, t in enumerate(texts)]
    got = repeated_spans.remove_repeats(frame(spark, rows, extra=True).repartition(3)).drop("spans")
    assert rows_of(got) == brute_removed(rows)


def test_repeated_spans_of_nothing(spark):
    assert repeated_spans.remove_repeats(frame(spark, [])).count() == 0


def edit_distance_within(item, text):
    """Least distance of ``item`` to a stretch of ``text``, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_myers_against_the_table():
    rng = random.Random(4)
    for _ in range(300):
        item = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 12)))
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 30)))
        least = edit_distance_within(item, text)
        found = decontamination.best_match(item, text, len(item))
        assert found[0] == least
        assert edit_distance_within(item, text[found[1] : found[2]]) == least
        if least:
            assert decontamination.best_match(item, text, least - 1) is None


def test_contaminated(spark):
    rng = random.Random(8)
    items = [(1, prose(500, 40)), (2, prose(501, 25)), (2, prose(501, 25)), (3, "short one"), (4, None), (5, ""), (None, prose(502, 30)), (6, prose(503, 30))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def edited(text, n):
        text = list(text)
        for _ in range(n):
            text[rng.randrange(len(text))] = rng.choice(["", "x", "yz"])
        return "".join(text)

    texts = [items[0][1], prose(1, 30) + "\n" + items[0][1].upper().replace(" ", "  ") + "! " + prose(2, 30), edited(items[1][1], 3), edited(items[1][1], 40),
             "Short  ONE", "a short one here", items[6][1] + " " + items[7][1], items[0][1][:120]]
    rows = awkward() + [(100 + i, t, None, None, None) for i, t in enumerate(texts)]
    want = set()
    for doc_id, text, *_ in rows:
        normal = decontamination.normalized(text or "")
        for item_id, item in items:
            item = decontamination.normalized(item or "")
            if item and (normal == item if len(item) < 20 else normal and edit_distance_within(item, normal[:3000]) <= decontamination.budget(item)):
                want.add((doc_id, item_id))
    for chars in (1_000_000, 200):
        found = decontamination.contaminated(frame(spark, rows, extra=True), benchmark, block_chars=chars).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == want
        assert {(100, 1), (101, 1), (102, 2), (104, 3), (106, None), (106, 6)} <= want and not any(d in (103, 105, 107) for d, _ in want)
        place = next(r for r in found if (r["doc_id"], r["item_id"]) == (101, 1))
        assert decontamination.normalized(texts[1][place["start"] : place["end"]]) == items[0][1]
    clean = decontamination.without_contaminated(frame(spark, rows, extra=True), benchmark)
    assert clean.columns == frame(spark, rows, extra=True).columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(d) for d, *_ in rows if d not in {d for d, _ in want})
    assert decontamination.contaminated(frame(spark), benchmark.filter("false")).count() == 0


@pytest.mark.parametrize("words", [4, 8, 18, 43, 72])
def test_a_tenth_of_an_item_may_be_edited(spark, words):
    item = prose(600 + words, words)
    most = len(item) // 10

    def edited(n):
        at = {len(item) * (2 * j + 1) // (2 * n) for j in range(n)}
        return prose(1, 200) + " " + "".join("#" if p in at else c for p, c in enumerate(item)) + " " + prose(2, 200)

    texts = [edited(most), edited(most + 1), prose(3, 500)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    distances = [edit_distance_within(item, t) for t in texts]
    assert distances[:2] == [most, most + 1]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = decontamination.contaminated(frame(spark, rows), benchmark).collect()
    assert {(r["doc_id"], r["distance"]) for r in found} == {(i, d) for i, d in enumerate(distances) if d <= most}
    kept = decontamination.without_contaminated(frame(spark, rows), benchmark).collect()
    assert sorted(r["doc_id"] for r in kept) == [i for i, d in enumerate(distances) if d > most]


def test_growing_parts_lose_no_match():
    rng = random.Random(5)
    for _ in range(150):
        item = "".join(rng.choice("abcd") for _ in range(rng.randrange(20, 60)))
        copy = list(item)
        for _ in range(rng.randrange(8)):
            copy[rng.randrange(len(copy))] = rng.choice(["", "a", "bc", "x"])
        text = "".join(rng.choice("abcd") for _ in range(30)) + "".join(copy) + "".join(rng.choice("abcd") for _ in range(30))
        least = edit_distance_within(item, text)
        found = decontamination.Items([1], [item], 0.1).find(text)
        assert [d for _, d, _, _ in found] == ([least] if least <= len(item) // 10 else [])


def page(body, head="<title>t</title><script>if (a < b) x('</p>')</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def texts_of(html):
    return [t for t, z in html_extraction.blocks(html) if z != html_extraction.DROP]


def test_blocks():
    assert texts_of(None) == texts_of("") == []
    assert texts_of(page("<p>a &amp; b&nbsp;&lt;c&gt; <b>d</b>e<p>f\n g<br>h")) == ["a & b <c> de", "f g h"]
    assert texts_of(page("<nav><ul><li>x</li></ul></nav><div class='site-header'>y</div><p class=body-text>z</p><form><p>q</p></form>")) == ["z"]
    assert texts_of(page("<header>h</header><article><header><h1>T</h1></header><p>z</p><div class='comments'><p>c</p></div></article>")) == ["T", "z"]
    assert texts_of("plain <a href='x>y'>text</a> <a href=\"cut") == ["plain text"]
    assert texts_of(page("<nav>menu<article><p>never closed menu</p></article>")) == ["never closed menu"]


@pytest.mark.parametrize("name", ["layout has-sidebar", "overflow-hidden", "with-header", "social-theme", "page--no-comments", "menu-open"])
def test_wrapped_articles_stay(name):
    for inner in ("<article><p>z</p></article>", "<main><p>z</p></main>", "<div class='post-content'><p>z</p></div>"):
        kept = [t for t, z in html_extraction.blocks(page(f"<div class='{name}'><nav>n</nav><section>{inner}</section></div>")) if z == html_extraction.MAIN]
        assert kept == ["z"]


def test_hidden_is_an_attribute_or_a_class():
    assert texts_of(page("<p title='a hidden gem'>a</p><p data-x='hidden'>b</p><div class='hidden-xs'>c</div>")) == ["a", "b", "c"]
    assert texts_of(page("<p hidden>a</p><p class='x hidden'>b</p><div aria-hidden='true'>c</div><p style='display: none'>d</p><p hidden=''>e</p>f")) == ["f"]


def test_listed_articles_go_where_the_page_has_its_own():
    listed = "<div class='comments'><article><p>c</p></article></div><div class='related'><article>r</article></div>"
    assert texts_of(page(f"<article><p>long text</p>{listed}</article>{listed}")) == ["long text"]
    assert texts_of(page(f"<p>long text</p>{listed}")) == ["long text"]
    assert texts_of(page("<div class='widget'><article><p>long text</p></article></div><p>x</p>")) == ["long text", "x"]


def test_page_differencing(spark):
    furniture = "<div>Home of things</div><div>Ways to reach us</div>"
    rows = [(i, f"http://h.org/a/{i}", page(f"{furniture}<div>{prose(i, 20)}</div><div>end line</div>"), "x") for i in range(6)]
    rows += [(10, "http://h.org/b/1", page("<article><p>quoted</p><p>own words</p></article><div>outside</div>"), "x"),
             (11, "http://h.org/b/2", page("<article><p>quoted</p><p>other words</p></article>"), "x"),
             (12, "http://lone.org/", page("<p>only page</p>"), "x"), (13, None, page("<p>no url</p>"), "x"), (14, "http://n.org/", None, "x"),
             (15, "http://c.org/1", page("<p>twin</p>"), "x"), (16, "http://c.org/2", page("<p>twin</p>"), "x"), (0, rows[0][1], rows[0][2], "x"), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extraction.extract(pages)
    assert got.columns == ["page_id", "url", "text"]
    found = rows_of(got)
    assert len(found) == len(rows)
    text = {i: t for i, _, t in found}
    assert all(text[i] == prose(i, 20) for i in range(6))
    assert text[10] == "quoted\nown words" and text[11] == "quoted\nother words"
    assert (text[12], text[13], text[14], text[15], text[None]) == ("only page", "no url", "", "twin", "")
    assert html_extraction.extract(pages.filter("false")).count() == 0


def test_copies_are_compared_with_a_page_that_differs(spark):
    shell = "<div>Home of things</div><div>{}</div><div>Ways to reach us</div>"
    bodies = ["first", *["copied"] * 5, "last", "copied"]
    rows = [(i, f"http://h.org/a/{i}", page(shell.format(b))) for i, b in enumerate(bodies)]
    found = html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert [r["text"] for r in found.orderBy("page_id").collect()] == bodies


def test_furniture_at_the_ends_of_articles_goes(spark):
    notice, more = "We use cookies", "Read also our other pages"
    rows = []
    for i in range(7):
        quoted = "<p>a paragraph that all quote</p>"
        text = f"<p>{prose(i, 20)}</p>{quoted}<p>{prose(50 + i, 20)}</p>"
        rows.append((i, f"http://h.org/a/{i}", page(f"<main><div>{notice}</div><h1>Title {i}</h1><div>menu</div>{text}<div>{more}</div></main>")))
        # versions of one article lose nothing
        rows.append((20 + i, f"http://v.org/{i}", page(f"<article><p>{prose(80, 20)}</p><p>{prose(81, 20)}</p><p>Version {i}</p></article>")))
    rows += [(40, "http://two.org/1", page(f"<main><p>{notice}</p><p>x</p></main>")), (41, "http://two.org/2", page(f"<main><p>{notice}</p><p>y</p></main>"))]
    found = html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    text = {r["page_id"]: r["text"] for r in found.collect()}
    for i in range(7):
        assert text[i] == "\n".join([f"Title {i}", prose(i, 20), "a paragraph that all quote", prose(50 + i, 20)])
        assert text[20 + i] == "\n".join([prose(80, 20), prose(81, 20), f"Version {i}"])
    assert (text[40], text[41]) == (f"{notice}\nx", f"{notice}\ny")


def test_shared_lines_is_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(500):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(9))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        common = [x for x, s in zip(a, html_extraction.shared_lines(a, b)) if s]
        left = iter(b)
        assert len(common) == table[-1][-1] and all(x in left for x in common)


def test_pipeline_stages(spark, tmp_path):
    leak = prose(900, 40)
    rows = awkward() + [(20, prose(20, 70) + " password=abcdef123456 " + prose(21, 10), "en", "s", 5), (21, prose(22, 40) + " " + leak, "en", "s", 5),
                        (22, "bad " * 80, "en", "s", 5), (23, prose(23, 90), None, None, None), (24, prose(23, 90) + " more", "en", "s", 5)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
        if name != "pack":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = {name: sorted(r["doc_id"] for r in d.collect() if r["doc_id"] is not None) for name, d in seen.items()}
    assert ids["quality"] == [1, 1, 2, 6, 20, 21, 23, 24]
    assert ids["dedup"] == [1, 6, 20, 21, 23]
    assert ids["decontaminate"] == ids["secrets"] == [1, 6, 20, 23]
    clean = next(r for r in seen["secrets"].collect() if r["doc_id"] == 20)
    assert "abcdef123456" not in clean["text"] and clean["n_chars"] == len(clean["text"])
    check_packing([tuple(r) for r in seen["secrets"].filter("doc_id is not null").collect()], seen["pack"].filter("doc_id is not null").collect())
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert rows_of(whole.select("doc_id", "piece", "length", "ids_crc32")) == rows_of(seen["pack"].select("doc_id", "piece", "length", "ids_crc32"))


def test_pipeline_near_duplicates_from_four_fifths(spark, tmp_path):
    def pair(seed, words, tail):
        base = prose(seed, words)
        return base, base + " " + " ".join(f"new{seed}x{k}" for k in range(tail))

    texts = [*pair(40, 94, 20), *pair(41, 94, 25)]
    shares = [len(shingle_set(a) & shingle_set(b)) / len(shingle_set(a) | shingle_set(b)) for a, b in (texts[:2], texts[2:])]
    assert 0.8 < shares[0] < 0.83 and 0.77 < shares[1] < 0.8
    docs = frame(spark, [(i, t, "en", "s", 5) for i, t in enumerate(texts)])
    kept = dict(corpus_pipeline.STAGES)["dedup"](spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3]
    assert near_duplicates.one_of_each(docs).count() == 4
