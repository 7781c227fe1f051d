import hashlib
import random

import numpy as np

from ledgerflow.llm import html_extract, neighbours, warc
from ledgerflow.llm.html_blocks import best_path, chosen_text, parse, text_under


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, pos):
        return self.data[pos:pos + n]


def test_salvage_recovers_what_damage_left():
    random.seed(2)
    rec = []
    for i in range(30):
        p = random.randbytes(random.randint(0, 3000))
        rec.append(warc.record_bytes("response", f"urn:page:{i}", f"http://x/{i}", p, None, hashlib.sha1(p).hexdigest()))
    for parts in ([warc.member(r) for r in rec], rec):
        data, ends = b"".join(parts), np.cumsum([0] + [len(p) for p in parts]).tolist()
        for _ in range(80):
            d, a, n = bytearray(data), random.randrange(len(data)), random.choice([1, 5, 400, 5000])
            mode = random.choice(["flip", "cut", "insert", "end"])
            if mode == "flip":
                d[a:a + n] = bytes(x ^ 0x55 for x in d[a:a + n])
            elif mode == "cut":
                del d[a:a + n]
            elif mode == "insert":
                d[a:a] = random.randbytes(n)
            else:
                del d[a:]
            hi = {"insert": a, "end": len(data)}.get(mode, a + n)
            got = list(warc.salvage(Bytes(bytes(d)), len(d)))
            ids = [int(x["head"]["warc-record-id"][10:-1]) for k, _, _, x in got if k == "record"]
            assert {i for i in range(30) if ends[i + 1] <= a or ends[i] >= hi} <= set(ids) and ids == sorted(set(ids))
            assert [s for _, s, _, _ in got] == [0, *[e for _, _, e, _ in got]][:-1] and got[-1][2] == len(d)     # no byte unaccounted for
    assert list(warc.salvage(Bytes(b""), 0)) == []


def test_archives_round_trip(spark):
    big = "é" * 600
    rows = [(1, "http://a", big, "x"), (2, "http://a", big, "x"), (3, None, None, "x"), (4, "http://b c\r\n", "short", "x"), (5, "u", "short", "x"),
            (None, "u", big, "x"), (2, "http://a", big, "x"), (6, "u", "a" * 200_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    got = warc.archived_pages(df).collect()
    want = []
    for i, _, h, _ in rows:
        b = (h or "").encode()
        rev = h == big and i != 2
        want.append((i or -1, len(b), hashlib.sha1(b).hexdigest(), "revisit" if rev else "response", 2 if rev else None))
    assert sorted(map(str, want)) == sorted(str((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)
    assert warc.archived_pages(df.limit(0)).count() == 0
    shuffled = warc.with_roles(df, broadcast_rows=0)
    assert sorted(r.refers_to or 0 for r in shuffled.collect()) == sorted(w[4] or 0 for w in want)


def test_main_text_of_a_page():
    page = """<!DOCTYPE html><head><title>T</title></head><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li>a<li>b</ul></nav>
<div id=cookie-notice>We use cookies</div><div class="layout"><aside>side</aside><div class="sidebar">links</div><div class="post-12 content with-sidebar">
<h1>Title &amp; more</h1><p>One <b>two<br>three</b> a &lt; b &nbsp; x<p>Four<form><input>q</form><ul><li>i1<li>i2</ul><div class="ad-box">Buy!</div>
<table><tr><td>c1<td>c2</table><p>End <script>var x="</p>"</script>tail</p></div><div class="comments"><p>""" + "Very long comment. " * 40 + "</p></div></div><footer>f"
    found = parse(page)
    assert text_under(found, [best_path(found)[0]]) == "Title & more\nOne two three a < b x\nFour\ni1\ni2\nc1\nc2\nEnd tail"
    for odd in ("", "plain", "<p", "<!-- open", "<div><p>x", "</p></div>", "<script>", "a < b > c", "<p a='>'>t</p>", "<table><td>x<table><td>y"):
        parse(odd)
    assert [t for _, t in parse("plain &eacute;")] == ["plain é"]


def test_articles_survive_their_class_names_and_neighbours():
    long = "This sentence is part of the article and long enough to be one. " * 4
    own = lambda html, paths=(): chosen_text(parse(html), list(paths))
    assert own(f'<div class="main-content ad-free"><p>{long}</p></div><div>foot</div>') == long.strip()
    assert own(f'<div class="post has-comments">{long}</div><p>x</p>') == long.strip()
    assert own(f'<body><div class="content"><div><p>{long}</p></div><div class="text"><p>{long * 3}</p></div></div><div>foot</div></body>') \
        == long.strip() + "\n" + (long * 3).strip()
    assert own(f'<body><div class="a">hi</div><section class="b"><p>{long}</p></section></body>', ["/body/div.a"]) == long.strip()
    assert own(f'<body><div class="related"><p>{long}</p></div></body>') == long.strip()              # all there is
    assert own(f'<body><div class="comment-list"><p>{long}</p></div><div><p>Short.</p></div></body>') == "Short."
    assert own(f'<div class="w-1/2"><p>{long}</p></div><div class="ads">{long}</div>', ["/div.w-|"]) == long.strip()


def test_hostile_pages_take_time_in_proportion():
    import time

    n = 125_000
    for page in ("<div>x" * n, '<a "' * 2 * n, "<b>x<hr>" * n, "<p>x" * n, "<" * 4 * n, "<!" * n, "<!--" * n, "<script>" * n, "<table><tr><td>" * (n // 3),
                 "<a b='" * n, '<a b="x>' * n, "<i " + "a " * n, "</div>" * n, "<div class='" + "x " * n + "'>t", "<li>x" * n, "&amp" * n, "<b>" * n + "x<p>y" * n):
        at = time.perf_counter()
        found = parse(page)
        chosen_text(found, ["/div/div", "/p"])
        assert time.perf_counter() - at < 15, page[:10]


def test_containers_of_random_trees_equal_brute_force():
    import random

    rng = random.Random(4)

    def grow(depth):
        tag = rng.choice(["div", "section", "p", "article", "ul"]) if depth < 5 else "p"
        kids = [] if tag == "p" else [grow(depth + 1) for _ in range(rng.randint(0, 3))]
        return tag, rng.choice(["", "a", "b"]), "w" * rng.randint(1, 40) if tag == "p" else "", kids

    def write(t):
        return f"<{t[0]} class='{t[1]}'>{t[2]}{''.join(map(write, t[3]))}</{t[0]}>"

    def walk(t, path, article=False):
        """(path, score, element) of every element, parents first."""
        path += "/" + t[0] + ("." + t[1] if t[1] else "")
        article = article or t[0] == "article"
        kids = [list(walk(k, path, article)) for k in t[3]]
        score = len(t[2]) + sum(k[0][1] * (0.8 if k[0][2] in ("div", "section", "article") else 1) for k in kids)
        return [(path, score, t[0], article), *(x for k in kids for x in k)]

    for _ in range(200):
        tree = ("div", "", "", [grow(0) for _ in range(3)])
        found = parse(write(tree))
        flat = [x for x in walk(tree, "") if x[2] in ("div", "section")]
        if any(x[2] == "article" for x in walk(tree, "")) or not found:
            continue
        path, score = best_path(found)
        assert abs(score - max(x[1] for x in flat)) < 1e-9 and path == next(x[0] for x in flat if abs(x[1] - score) < 1e-9)


def test_hosts_vote(spark):
    art = lambda t, n: f"<body><div class='main p{n}'><p>{t}</p></div><div class='box'><p>{'other ' * 3}</p></div></body>"
    rows = [(i, "http://h.example/x", art("long text " * 20, i), "x") for i in range(9)] + [
        (9, "http://h.example/y", art("tiny", 9), "x"), (10, None, None, "x"), (11, "http://z.example/", "bare text", "x"), (9, "http://h.example/y", art("tiny", 9), "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in html_extract.main_text(df).collect()}
    assert got[9].text == "tiny" and got[0].text == ("long text " * 20).strip() and got[10].text == "" and got[11].text == "bare text"
    assert html_extract.main_text(df).count() == 13 and all(r.n_chars == len(r.text) for r in got.values())
    a, b = (sorted(map(str, html_extract.main_text(df, broadcast_hosts=n).collect())) for n in (100, 0))
    assert a == b and html_extract.main_text(df.limit(0)).count() == 0


def brute(x, least):
    ok = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for v in x]
    u = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if k else None for v, k in zip(x, ok)]
    return [[j for j in range(len(x)) if j != i and ok[i] and ok[j] and len(u[i]) == len(u[j]) and float(u[i] @ u[j]) >= least] for i in range(len(x))]


def test_links_match_brute_force(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(40, 8))
    x = [*(base[i % 40] + rng.normal(size=8) * rng.choice([0.0, 0.05, 0.2]) for i in range(300))]
    hot = rng.normal(size=8)
    x = [v.tolist() for v in x] + [(hot + rng.normal(size=8) * 0.03).tolist() for _ in range(150)] + [
        None, [], [0.0] * 8, [None] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [0.0] * 7, [1.0, 2.0], [2.0, 4.0], x[0].tolist(), (x[0] * 3).tolist()]
    links = brute(x, 0.95)
    df = spark.createDataFrame([(i, v, 1, 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, v int, rep int")
    got = {r.vec_id: r for r in neighbours.near_vectors(df, max_shard=60, sample_rows=300, audit_queries=50).collect()}
    assert len(got) == len(x)
    have, want = sum(r.n_links for r in got.values()), sum(map(len, links))
    assert 0.97 * want <= have <= want and all(got[i].n_links <= len(links[i]) for i in got)
    comp = list(range(len(x)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, ls in enumerate(links):
        for j in ls:
            a, b = sorted((root(i), root(j)))
            comp[b] = a
    assert np.mean([got[i].component_id == root(i) for i in got]) > 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert neighbours.near_vectors(df.limit(0)).count() == 0
    assert [r.n_links for r in neighbours.near_vectors(df.where("vec_id = 450")).collect()] == [0]


def hard_to_search(rng, pairs):
    """A shard of about 1,000 vectors: a large group, and pairs whose only near vector is the other one."""
    hot = rng.normal(size=16)
    far = rng.normal(size=(pairs, 16))
    return [*(hot + rng.normal(size=16) * 0.01 for _ in range(400)), *far, *(far + rng.normal(size=far.shape) * 0.02)]


def test_audit_weighs_vectors_not_links(spark, monkeypatch):
    x = [v.tolist() for v in hard_to_search(np.random.default_rng(3), 60)]
    monkeypatch.setattr(neighbours, "search", lambda x, graph, first, q, least, beam: np.flatnonzero(x @ q >= least) if (x @ q >= least).sum() > 5 else np.zeros(0, int))
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in neighbours.near_vectors(df).collect()}
    assert got == {i: len(ls) for i, ls in enumerate(brute(x, 0.95))}


def test_recall_of_small_groups_counts():
    want = {**{i: 300 for i in range(300)}, 400: 1, 401: 1}
    got = {i: 300 for i in range(300)}
    assert neighbours._recall(want, got) == 0 and neighbours._recall(want, {**got, 400: 1, 401: 1}) == 1 and neighbours._recall({}, {}) == 1


def test_parts_without_a_start_are_searched(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(18, 32))
    x = [(b + rng.normal(size=32) * 0.02).tolist() for b in base for _ in range(55)]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = neighbours.near_vectors(df, audit_queries=0).collect()                # what the search finds without help
    assert len(got) == len(x) and {r.n_links for r in got} == {54}


def test_links_count_for_both_ends(spark, monkeypatch):
    x = [v.tolist() for v in hard_to_search(np.random.default_rng(5), 30)]
    links = brute(x, 0.95)
    blind = lambda x, graph, first, q, least, beam: np.flatnonzero((x @ q >= least) & (x[:, 0] >= q[0]))
    monkeypatch.setattr(neighbours, "search", blind)                            # each link is found from one end
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in neighbours.near_vectors(df, max_shard=200, audit_queries=0).collect()}
    assert got == {i: len(ls) for i, ls in enumerate(links)}


def test_a_large_group_writes_no_pairs(spark):
    rng = np.random.default_rng(6)
    hot = rng.normal(size=16)
    x = np.stack([hot + rng.normal(size=16) * 0.01 for _ in range(300)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    schema = "shard int, rank int, rep long, v array<double>, copies long, nbs array<long>"
    members = spark.createDataFrame([(0, 0, i, v.tolist(), 2, [j for j in (i - 1, i + 1) if 0 <= j < 300]) for i, v in enumerate(x)], schema)
    asks = members.selectExpr("shard", "rep", "v", "shard as home")
    got = neighbours._hits(members.drop("nbs"), members.select("rep", "nbs"), asks, 0.95, 32).collect()
    assert sorted(r.rep for r in got if r.finds) == list(range(300)) and all((r.n, r.copies) == (299, 598) for r in got if r.finds)
    assert len(got) == 300 + 300 + 299                                          # what it found, what found it, a spanning tree
    assert not any(isinstance(c, list) for r in got for c in r)


def test_salvage_of_a_record_right_behind_a_cut():
    def record(i):
        p = b"text %d " % i * 200
        return warc.record_bytes("response", f"urn:page:{i}", f"http://x/{i}", p, None, hashlib.sha1(p).hexdigest())

    a, b, c = map(record, range(3))
    flipped = a[:-1] + bytes([a[-1] ^ 0x55])
    for first in (a[:40], a[:len(a) // 2], a[:-1], flipped):
        data = first + b + c
        got = list(warc.salvage(Bytes(data), len(data)))
        assert [(k, s, e) for k, s, e, _ in got] == [("gap", 0, len(first)), ("record", len(first), len(first) + len(b)), ("record", len(first) + len(b), len(data))]


def numbered_records(n, size=200):
    text = [b"text %d " % i * size for i in range(n)]
    return [warc.record_bytes("response", f"urn:page:{i}", f"http://x/{i}", p, None, hashlib.sha1(p).hexdigest()) for i, p in enumerate(text)]


def test_records_inside_one_member_are_all_read():
    rec = numbered_records(30, 4000)
    ids = lambda got: [int(x["head"]["warc-record-id"][10:-1]) for k, _, _, x in got if k == "record"]

    def read(data):
        got = list(warc.salvage(Bytes(data), len(data)))
        assert [s for _, s, _, _ in got] == [0, *[e for _, _, e, _ in got]][:-1] and got[-1][2] == len(data)
        return got

    whole = warc.member(b"".join(rec))
    assert ids(read(whole)) == list(range(30)) and all(k == "record" for k, *_ in read(whole))
    bad = warc.member(b"".join(rec[:10]) + rec[10].replace(b"text 10", b"tEXt 10", 1) + b"".join(rec[11:]))       # fails its digest only
    got = read(warc.member(rec[0]) + bad + warc.member(rec[29]))
    assert ids(got) == [0, *range(10), *range(11, 30), 29] and [w for k, _, _, w in got if k == "gap"] == ["block digest"]
    cut = read(whole[:len(whole) * 2 // 3])                            # what is whole before the cut counts
    assert ids(cut) == list(range(len(ids(cut)))) and 5 < len(ids(cut)) < 30 and cut[-1][0] == "gap"


def test_long_headers_are_no_damage():
    rec = numbered_records(3)
    long = rec[1].replace(b"\r\nWARC-Date", b"\r\nX-Long: " + b"y" * 6_000_000 + b"\r\nWARC-Date", 1)
    for parts in ((rec[0], long, rec[2]), map(warc.member, (rec[0], long, rec[2]))):
        data = b"".join(parts)
        assert [k for k, *_ in warc.salvage(Bytes(data), len(data))] == ["record"] * 3


def test_short_payloads_are_spread_over_keys(spark):
    df = spark.createDataFrame([(i, f"http://h/{i}", "short") for i in range(50)], "page_id long, url string, html string")
    rows = warc.with_roles(df, broadcast_rows=-1)
    assert rows.count() == 50 and rows.where("refers_to is not null").count() == 0


def test_audit_and_fit_take_other_rows(spark):
    from ledgerflow.llm.common import hash_share

    df = spark.range(5000).withColumnRenamed("id", "rep")
    fit, other = (df.where(hash_share("rep", n, 5000, after)) for n, after in ((1000, 0), (400, 1000)))
    assert 900 < fit.count() < 1100 and 330 < other.count() < 470 and fit.join(other, "rep").count() == 0
    assert df.where(hash_share("rep", 400, 5000, 6000)).count() == 0 and df.where(hash_share("rep", 9000, 5000)).count() == 5000
