"""Pages, fingerprints, shards, near-duplicates and the pipeline against plain versions."""

import hashlib
import random
import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from recurra.llm import html_content, merkle, order_minhash, sharding

SMALL = "/root/testdata/sf0.001"


def test_pages_against_their_article(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r.text for r in html_content.extract(pages).collect()}
    for p in pages.collect():
        inner = re.search("<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("<(?:/?p|/?h1|br)[^>]*>", inner)]
        assert got[p.page_id] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("name", "sidebar comments newsletter related cookie-notice menu share-buttons ad-slot site-footer disqus_thread".split())
def test_parts_that_are_not_the_article(name):
    other = f'<div class="{name}"><p>This is a paragraph of other text, long enough to be taken for content.</p><p>And more of it.</p></div>'
    page = f'<body><div id="wrap"><article class="post"><h1>Head &amp; line</h1><p>One para of<br>text that is long enough.</p>{other}<p>Two&nbsp; <b>three.<p>Four.</article>{other}</div></body>'
    assert html_content.main_text(page)[0] == "Head & line\nOne para of\ntext that is long enough.\nTwo three.\nFour."


def test_pages_of_other_layouts():
    bare = "<html><head><title>x</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><h1>Head line</h1><p>One para of text that is long enough to count.</p><p>Two.</p><script>var t='<p>no</p>'</script><footer>c</footer></body>"
    assert html_content.main_text(bare)[0] == "Head line\nOne para of text that is long enough to count.\nTwo."
    for page in ("", "<", "<div", "<p", "<!-- open", "<script>x", "plain", "<div>" * 3000 + "deep", "</p></div>", "<a" * 2000, "&#x; &nosuch; <b>"):
        html_content.main_text(page)


@pytest.mark.parametrize("before", [
    "<datalist><option value=a></datalist>", "<select><option>a<option>b</select>", "<select><option>a", "<option>a", "<div><button>Menu</div>", "<button><b>Menu", "<svg><path d='x'><text>t</text>",
    "<svg><svg></svg><text>t</text></svg>", "<object data=x>", "<canvas>", "<button><div>Menu</div></button>"])
def test_controls_without_an_end(before):
    page = f'<body>{before}<article class="post"><h1>Head line</h1><p>One para of text that is long enough.</p>{before}<p>It says <math><mi>x</mi><mo>=</mo><mn>1</mn></math> and ends.</p></article></body>'
    assert html_content.main_text(page)[0] == "Head line\nOne para of text that is long enough.\nIt says x=1 and ends."
    assert html_content.main_text(before * 3000) == ("", 0, 0)


def test_only_an_attribute_of_that_name_hides():
    for attributes in (' style="overflow:hidden"', ' title="the hidden valley"', " data-x='display:none'", ' data-hidden="1" class=hidden-gem'):
        assert "hidden" not in html_content.evidence_of("div", attributes)[0], attributes
    for attributes in (" hidden", ' a="b" HIDDEN class=x', ' hidden=""', ' style="color:red; display : none"'):
        assert "hidden" in html_content.evidence_of("div", attributes)[0], attributes
    found, mark = html_content.evidence_of("p", ' class="post main" keep')
    assert sorted(found) == ["<p", "name:main", "name:post"] and mark == "keep"


def test_marginals_are_exact_on_a_small_tree():
    nodes = html_content.parse('<body><div class="content"><p>One two three.</p></div><nav>x</nav></body>')
    model = html_content.model()
    n, total, yes = len(nodes), 0.0, [0.0] * len(nodes)
    for bits in range(1 << n):
        s = [bits >> i & 1 for i in range(n)]
        w = sum(model.unary[e][s[i]] for i, x in enumerate(nodes) for e in x.evidence if e in model.unary)
        w = np.exp(w + sum(model.joint.get(x.kind, model.general)[s[x.parent]][s[i]] for i, x in enumerate(nodes) if i))
        total += w
        yes = [y + w * b for y, b in zip(yes, s)]
    assert np.allclose(model.marginals(nodes), [y / total for y in yes])


def test_pages_with_nulls(spark):
    rows = [(None, None, None), (1, None, ""), (1, "u", "<article><p>Text of it.</p></article>"), (2, "u", None)]
    pages = spark.createDataFrame([(*r, "t", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = Counter((r.page_id, r.url, r.text, r.n_chars) for r in html_content.extract(pages).collect())
    assert got == Counter([(None, None, "", 0), (1, None, "", 0), (1, "u", "Text of it.", 11), (2, "u", "", 0)])
    assert html_content.extract(pages.where("false")).count() == 0


def check_fingerprints(rows, got):
    order = sorted(rows)
    texts = [t for _, t in order]
    for k, (i, t) in enumerate(order):
        following = texts[(k + 1) % len(texts)]
        half = len(t) // 2
        changed = t[: len(t) - half] + following[:half]
        a, b, c = merkle.trees([t, changed, following])
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (a.fingerprint, b.fingerprint)
        assert (got[i].near_edited, got[i].near_next) == (merkle.likeness(a, b), merkle.likeness(a, c))


def test_fingerprints_of_successors(spark):
    rng = random.Random(4)
    rows = [(i * 10 % 301 - 50, "\n".join(" ".join(rng.choice("anne bert carl doro emil fritz".split()) + str(rng.randrange(40)) for _ in range(rng.randrange(30))) for _ in range(rng.randrange(6)))) for i in range(301)]
    got = {r.doc_id: r for r in merkle.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    check_fingerprints(rows, got)
    one = {r.doc_id: r for r in merkle.fingerprints(spark.createDataFrame([(5, "a é b")], "doc_id long, text string")).collect()}
    check_fingerprints([(5, "a é b")], one)


def test_trees_tell_where_texts_differ():
    lines = [f"line {i} " + " ".join(f"w{i}x{k}" for k in range(40)) for i in range(30)]
    a, same = merkle.trees(["\n".join(lines)] * 2)
    assert a == same and merkle.likeness(a, same) == 1 and merkle.differing(a, same) == []
    lines[17] = "changed altogether"
    b = merkle.trees(["\n".join(lines)])[0]
    assert 0.9 < merkle.likeness(a, b) < 1 and len(merkle.differing(a, b)) == 1
    swapped = merkle.trees(["x\ny\n", "y\nx\n"])
    assert merkle.likeness(*swapped) < 1
    assert merkle.Tree.parse(b.fingerprint) == b and merkle.Tree.parse(merkle.trees([""])[0].fingerprint).sections == []


def test_short_texts_are_like_their_edited_text():
    rng = random.Random(13)
    found = []
    for _ in range(200):
        words = [f"w{rng.randrange(10**6)}" for _ in range(16)]
        a, b = merkle.trees([" ".join(words), " ".join(words[:8] + [f"w{rng.randrange(10**6)}" for _ in range(8)])])
        found.append(merkle.likeness(a, b))
    assert sum(x == 0 for x in found) < 40 and 0.15 < sum(found) / 200 < 0.6
    long = " ".join(f"x{i}" for i in range(200))
    a, b = merkle.trees([long + "\nend", "another line\n" + long + "\nend"])
    assert merkle.likeness(a, b) > 0.9  # equal paragraphs have equal pieces


def test_fingerprints_of_edge_rows(edge, edge_rows, none):
    rows = merkle.fingerprints(edge).collect()
    assert Counter((r.doc_id, r.n_chars) for r in rows) == Counter((i, len(t or "")) for i, t, *_ in edge_rows)
    assert merkle.fingerprints(none).count() == 0


def check_shards(rows, shards=40):
    for k in range(shards):
        own = [r.slot for r in rows if r.shard == k]
        assert sorted(own) == list(range(len(own)))
    homes = {}
    for r in rows:
        homes.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert all(len(h) == 1 for h in homes.values())
    return [sum(r["size"] for r in rows if r.shard == k) for k in range(shards)]


def test_shards_are_level_with_and_without_small_blocks(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = sharding.assign(docs).collect()
    sums = check_shards(rows)
    group = Counter()
    for r in rows:
        group[r.text_crc32] += r["size"]
    assert len(rows) == docs.count()
    assert max(sums) <= max(1.02 * sum(sums) / 40, max(group.values()))
    blocks = check_shards(sharding.assign(docs, sharding.Params(block=16, part=32)).collect())
    assert max(blocks) <= max(sum(blocks) / 40 + 2 * max(group.values()), 0)


def test_differencing_by_hand():
    sums, places = sharding.difference([np.array([s, 0]) for s in (8, 7, 6, 5, 4)])
    assert sorted(sums.tolist()) == [14, 16]  # the classic example: differences 2
    back = np.zeros(2, int)
    for s, p in zip((8, 7, 6, 5, 4), places):
        back[p[0]] += s
    assert back.tolist() == sums.tolist()


def test_shards_of_edge_rows(edge, edge_rows, none):
    rows = sharding.assign(edge).collect()
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((i, len((t or "").encode()) + 16) for i, t, *_ in edge_rows)
    check_shards(rows)
    assert sharding.assign(none).count() == 0


def plain_classes(rows):
    """Least id of the component of links with a Jaccard similarity of five-word shingles of 0.8 or more."""
    sets = {}
    for i, t in rows:
        w = (t or "").split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_duplicates_by_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(120)]
    texts = []
    for g in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(5, 300))]
        for _ in range(rng.randint(1, 6)):  # copies with a few changes, chains of them, moved blocks
            base = list(base)
            for _ in range(rng.randrange(4)):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
            cut = rng.randrange(len(base)) if g % 5 == 0 else 0
            texts.append(" ".join(base[cut:] + base[:cut]))
    texts += [" ".join([rng.choice(vocabulary) for _ in range(20)] + passage + [rng.choice(vocabulary) for _ in range(20)]) for _ in range(80)]  # a shared passage is no copy
    texts += ["", " ", "one two", "one  two", "one three", "the end of the line"]
    rows = list(enumerate(texts))
    got = {r.doc_id: r.class_id for r in order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == plain_classes(rows)


def test_near_duplicates_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r.class_id for r in order_minhash.classes(docs).collect()}
    assert got == plain_classes([(r.doc_id, r.text) for r in docs.collect()])
    kept = order_minhash.keep_one(docs)
    assert {r.doc_id for r in kept.collect()} == set(got.values()) and kept.columns == docs.columns


def test_near_duplicates_within_template_families(spark):
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(175)]  # of 204 words: two of the family are just below a link
    rows, planted = [], []
    for k in range(300):
        own = [word() for _ in range(29)]
        planted.append((2 * k, 2 * k + 1))
        rows += [(2 * k, " ".join(passage + own)), (2 * k + 1, " ".join(passage + own[:9] + [word() for _ in range(20)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in order_minhash.classes(docs).collect()}
    expected = plain_classes(rows)
    assert got == expected and all(expected[a] == expected[b] == a for a, b in planted)


def test_near_duplicates_with_moved_and_repeated_blocks(spark):
    rng = random.Random(12)
    rows = []
    for k in range(60):
        words = [f"v{rng.randrange(10**6)}" for _ in range(300)]
        cuts = [0, 75, 150, 225, 300] if k % 2 else [0, 150, 300]
        blocks = [words[a:b] for a, b in zip(cuts, cuts[1:])]
        for text in (words, [w for b in reversed(blocks) for w in b], words * 2):
            rows.append((len(rows), " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.class_id for r in order_minhash.classes(docs).collect()}
    assert got == plain_classes(rows) and set(got.values()) == set(range(0, 180, 3))


def test_near_duplicates_of_edge_rows(edge, edge_rows, none):
    rows = order_minhash.classes(edge).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in edge_rows)
    home = {}
    for r in rows:
        home.setdefault(r.doc_id, set()).add(r.class_id)
    assert home[4] == home[7] == {4} and home[5] == {4, 5} and len(home[1]) == 1 and home[1] == home[2] == home[3] < home[None]
    # a class has one name, and no other class has it
    assert len({(r.class_id, r.class_key) for r in rows}) == len({r.class_id for r in rows}) == len({r.class_key for r in rows})
    assert {r.least_id for r in rows if r.doc_id in (1, 2, 3)} == {None} and min(home[1]) < 0
    kept = Counter((r.doc_id, r.text) for r in order_minhash.keep_one(edge).collect())
    assert max(kept.values()) == 1 and len(kept) == len({(r.class_key) for r in rows})
    assert order_minhash.classes(none).count() == 0 and order_minhash.keep_one(none).count() == 0


def test_classes_of_texts_that_share_an_id(spark):
    rng = random.Random(12)
    text = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(60))
    near = lambda t: t + " tail"
    a, b, c, d = text(), text(), text(), text()
    rows = [(None, a), (None, b), (7, c), (7, d), (8, near(d)), (None, near(a)), (9, "x y")] + [(None, text()) for _ in range(150)] + [(None, b)] * 3
    got = order_minhash.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(rows)
    classes = {}
    for r in got:
        classes.setdefault(r.class_id, set()).add((r.doc_id, r.key, r.n_links))
    assert sorted(len({k for _, k, _ in members}) for members in classes.values())[-2:] == [2, 2] and len(classes) == 4 + 1 + 150
    assert sum(r.n_links for r in got) == 4 and len({r.class_key for r in got}) == len(classes)
    assert {r.class_id for r in got if r.doc_id == 8} < {r.class_id for r in got if r.doc_id == 7}
    # rows without an id are joined with the texts they equal, not with each other
    nodes = spark.createDataFrame([(0, None, 5)], "id long, doc long, mark long")
    assert order_minhash.gram_rows(spark.createDataFrame(rows, "doc_id long, text string"), nodes, order_minhash.Params()).count() == 0


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "id long, least long")
    got = {r.id: r.root for r in order_minhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_pipeline_of_odd_rows(spark, edge, edge_rows, none, tmp_path, monkeypatch):
    """Nulls, empty and very long texts, ties, repeated rows, clashing columns and an empty table, through every stage in sequence."""
    labels = spark.createDataFrame([(4, 1, 0), (7, 1, 0), (12, 0, 0), (None, 1, None), (6, None, 0)], "doc_id long, quality int, toxic int")
    for name, docs in (("odd", edge), ("none", none)):
        folder = tmp_path / name
        docs.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        now = spark.read.parquet(f"{folder}/documents.parquet")
        for stage, fn in corpus_pipeline.STAGES[:-1]:
            before = Counter(map(str, now.collect()))
            out = corpus_pipeline.stored(fn(spark, now, str(folder)), f"odd-{stage}")
            assert out.columns == docs.columns
            after = Counter(map(str, out.collect()))
            assert after <= before or stage == "secret_scan" and after.total() == before.total()
            now = out
        packed = corpus_pipeline.run(spark, str(folder)).collect()
        assert {r.doc_id for r in packed} == {r.doc_id for r in now.collect()}


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "quality_classifier", "near_duplicates", "secret_scan", "packing"]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stored(stage(spark, docs, SMALL), f"test-{name}")
        assert out.columns == columns
        before, after = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}
        assert set(after) <= set(before)
        if name == "near_duplicates":
            home = plain_classes([(i, r.text) for i, r in before.items()])
            assert set(after) == set(home.values())
        if name == "secret_scan":
            assert set(after) == set(before) and not any(re.search("[0-9a-f]{32}", r.text) for r in after.values())
        else:
            assert all(after[i] == before[i] for i in after)
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in packed} == set(after)


def test_shingles_are_counted_in_all_texts(spark):
    words = "the same five words here"
    rows = [(i, f"{words} and then {i} own ones {i * 7}") for i in range(300)] + [(300, None), (301, "")]
    params = order_minhash.Params()
    counts = order_minhash.common_shingles(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), params)
    mark = order_minhash.shingles(pa.array([words]), params.shingle)[1][0]
    grams = order_minhash.shingles(pa.array([rows[0][1]]), params.shingle)[1][0]
    assert len(mark) == 1 and counts.sum() == sum(max(len(set(zip(*[t.split()[k:] for k in range(5)]))), 0) for _, t in rows if t)
    assert mark[0] in grams and counts[order_minhash.cell(mark, params)][0] >= 300
    assert mark.view(np.int64)[0] not in order_minhash.rarest(grams, counts, params)[0]


def test_parities_leave_out_only_pairs_that_cannot_be_similar(spark):
    rng = np.random.default_rng(3)
    params, both = order_minhash.Params(), rng.integers(0, 1 << 63, 300, np.uint64)
    sets = [np.concatenate([both[: 300 - k], rng.integers(0, 1 << 63, k, np.uint64)]) for k in (0, 10, 25, 33, 34, 60, 90, 150)]
    # all share the first place of one shingle and are classes of their own
    rows = spark.createDataFrame([(1, i, 300, 0, i, 0, order_minhash.parities(x).tolist()) for i, x in enumerate(sets)], "bucket long, id long, size int, nth int, root long, main long, odd array<long>")
    got = {(r.id, r.least) for r in order_minhash.rare_pairs(rows, params).collect()}
    every = {(i, j): len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) for i in range(len(sets)) for j in range(i)}
    assert {p for p, s in every.items() if s >= params.similarity} <= got
    assert got and not got & {p for p, s in every.items() if s < 0.5}
