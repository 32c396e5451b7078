"""Corpus operators against brute force on small fixtures, with nulls, repeats, clashing names and empty tables."""

import base64
import hashlib
import itertools
import random
import re
import tracemalloc
from html.parser import HTMLParser

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracklake.llm import decontamination, embeddings, html_text, language, licenses, minhash, mixing, substrings, suffix_sort, url_filter, warc
from tracklake.llm.common import components, exact
from tracklake.session import staging_path

DOCS = "doc_id long, text string, lang string, source string, n_chars int, TEXT string, score int, key int, component_id int"
WORDS = [f"w{i}" for i in range(400)]


def docs_of(spark, rows):
    """Rows (doc_id, text, lang, source) beside columns whose names clash."""
    return spark.createDataFrame([(*r, 0, "x", 1, 2, 3) for r in rows], DOCS)


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and blank texts, repeated rows, one long text."""
    long = " ".join(random.Random(1).choices(WORDS, k=60_000))
    rows = [
        (None, "the null id text with some words in it", "en", "a"), (1, None, "en", "a"), (2, "", None, None), (3, " \t\n", "en", "a"),
        (4, "only one", "en", None), (5, long, "en", "b"), (5, long, "en", "b"), (6, long, None, "b"), (7, "... 123 !!!", "en", "a"),
    ]
    return docs_of(spark, rows)


# --- url filter


def test_blocks_follow_redirects_and_canonical_links_with_allow_first(spark):
    link = '<link href="{}" class=x rel="canonical">'
    rows = [
        (1, "http://a.org/en/1", link.format("https://x.example.com/en/9?q#f")),
        (2, "http://b.org/2", '<meta content="0; url=http://a.org/en/1" http-equiv=refresh>'),
        (3, "http://c.org/3", link.format("//www.example.com/en/1") + '<META HTTP-EQUIV="Refresh" content="5;URL=//b.net/fr/1">'),
        (4, "http://x.example.com/en/9?q", None),
        (5, "https://WWW.Example.com/en/7", ""),
        (6, "no host", link.format("/en/1")),
        (7, None, None),
        (8, "http://d.org/p/q.html", link.format("r.html")),
        (9, "http://d.org/p/r.html", None),
        (9, "http://d.org/p/r.html", None),
    ]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, verdict int")
    got = by_id(url_filter.judge(spark, pages), "page_id")
    verdicts = {k: (v["rule"], v["verdict"]) for k, v in got.items()}
    assert verdicts[1] == verdicts[2] == (None, "block")
    assert verdicts[3] == (None, "allow")  # its class holds an allowed and a blocked url
    assert verdicts[4] == ("example.com/en/", "block")
    assert verdicts[5] == ("www.example.com/en/", "allow")
    assert verdicts[6] == verdicts[7] == (None, "allow") and got[7]["host"] == "" == got[6]["path"]
    assert got[8]["component"] == got[9]["component"] == "d.org/p/q.html"
    assert url_filter.judge(spark, pages).count() == 10
    assert url_filter.judge(spark, pages.limit(0)).count() == 0


class Links(HTMLParser):
    """The first canonical link and refresh by the standard library's parser."""

    def __init__(self, html):
        super().__init__()
        self.canonical = self.refresh = self.plain = None
        self.feed(html)
        self.close()

    def handle_endtag(self, tag):
        self.plain = None if tag == self.plain else self.plain

    def handle_starttag(self, tag, attrs):
        if self.plain:  # the parser itself knows script and style only
            return
        a, self.plain = dict(attrs), tag if tag in ("title", "textarea") else None
        if tag == "link" and (a.get("rel") or "").strip().lower() == "canonical" and self.canonical is None:
            self.canonical = a.get("href") or ""
        if tag == "meta" and (a.get("http-equiv") or "").strip().lower() == "refresh" and self.refresh is None:
            self.refresh = re.split("url *= *", a.get("content") or "", flags=re.I)[-1].strip("\"' ")


def test_links_are_those_a_parser_reads(spark):
    rng = random.Random(5)
    link = lambda u: f'<link rel="canonical" href="{u}">'
    parts = [
        lambda u: link(u), lambda u: f"<!-- {link(u)} -->", lambda u: f"<script>var a = '{link(u)}'</script>", lambda u: f"<style>{link(u)}</style>",
        lambda u: f'<meta http-equiv="refresh" content="0; url=&quot;{u}&quot;">', lambda u: f"<META HTTP-EQUIV=refresh CONTENT='5;URL={u}'>",
        lambda u: f"<title>{link(u)}</title>", lambda u: "<p>text & more</p>", lambda u: f"<textarea>{link(u)}</textarea>",
    ]
    rows = []
    for i in range(300):
        urls = [rng.choice(["http://b.net/es/1?a=1&amp;b=2", "http://c.org/x", "//www.example.com/en/&#39;q", "/local?x=1&amp;amp;y"]) for _ in range(3)]
        rows.append((i, f"http://h{i}.org/d/p", "<html>" + "".join(rng.choice(parts)(u) for u in urls)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = by_id(url_filter.judge(spark, pages), "page_id")
    edges, nodes = [], {}
    for i, url, html in rows:
        found, me = Links(html), url.removeprefix("http://")
        nodes[i] = me
        for target in (found.canonical, found.refresh):
            if target:
                edges.append((me, target.split("://")[-1].removeprefix("//") if "//" in target else f"h{i}.org{target}"))
    least = {n: n for e in edges for n in e}
    for _ in range(len(least)):
        after = dict(least)
        for a, b in edges:
            after[a] = after[b] = min(after[a], after[b])
        if after == least:
            break
        least = after
    assert {i: v["component"] for i, v in got.items()} == {i: least.get(n, n) for i, n in nodes.items()}


def test_components_of_long_chains_and_hubs(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5000, 5000)]
    rng.shuffle(chain)
    edges = spark.createDataFrame([(b, a) if rng.random() < 0.5 else (a, b) for a, b in chain] + [(None, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(spark, edges, "test").collect()}
    assert got == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1400), 1000)}


# --- warc


def test_archives_round_trip_and_reject_magic_in_payloads(spark):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(i, f"http://h/{i}", ("x" * i + fake) * (i % 5)) for i in range(40)]
    rows += [(50, None, None), (51, "http://h/\r\nEvil: 1", ""), (52, "u", "é€" * 50), (53, "v", "é€" * 50), (53, "v", "é€" * 50), (None, "w", "é€" * 50)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    folder = staging_path(spark, "warc test")
    warc.write_archives(spark, pages.repartition(3), folder)
    read = warc.read_archives(spark, folder, range_bytes=500).collect()
    assert len(read) == len(rows)
    got = sorted((r.asDict() for r in warc.round_trip(spark, pages).collect()), key=lambda r: (r["page_id"] is None, r["page_id"]))
    payload = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, p in payload:
        if i is not None:
            first[p] = min(first.get(p, i), i)
    want = [
        {"page_id": i, "payload_bytes": len(p), "payload_digest": base64.b32encode(hashlib.sha1(p).digest()).decode(),
         "record_type": "revisit" if i is not None and i > first[p] else "response", "refers_to": first[p] if i is not None and i > first[p] else None}
        for i, p in payload
    ]
    assert got == sorted(want, key=lambda r: (r["page_id"] is None, r["page_id"]))
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_revisits_of_an_id_with_two_payloads(spark):
    pages = spark.createDataFrame([(1, "u", "AAA"), (1, "u", "BBBBB"), (2, "v", "AAA"), (3, "w", "BBBBB")], "page_id long, url string, html string")
    sha = lambda s: base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()
    got = {tuple(r) for r in warc.round_trip(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()}
    assert got == {(1, 3, sha("AAA"), "response", None), (1, 5, sha("BBBBB"), "response", None), (2, 3, sha("AAA"), "revisit", 1), (3, 5, sha("BBBBB"), "revisit", 1)}


# --- suffix sorting and substring removal


def test_suffix_order_and_common_prefixes_with_spilling_queues(tmp_path, monkeypatch):
    rng = np.random.default_rng(2)
    for trial in range(60):
        monkeypatch.setattr(suffix_sort, "PIECE", int(rng.integers(3, 30)))
        letters, limit = int(rng.integers(1, 4)), int(rng.integers(2, 12))
        strings = [bytes(rng.integers(97, 97 + letters, rng.integers(1, 40)).astype(np.uint8)) for _ in range(rng.integers(1, 8))]
        strings += strings[:1]
        folder = tmp_path / str(trial)
        folder.mkdir()
        shard = suffix_sort.Shard(iter(strings), str(folder), int(rng.integers(4, 60)), limit)
        got = [(p, c) for ps, cs in shard.suffixes() for p, c in zip(ps.tolist(), cs.tolist(), strict=True)]
        starts = np.append(0, shard.ends[:-1] + 1)
        order = sorted((s[o:], i, o) for i, s in enumerate(strings) for o in range(len(s)))
        text = {int(starts[i] + o): s[:limit] for s, i, o in order}
        assert [text[p] for p, _ in got] == [s[:limit] for s, *_ in order]
        shared = [sum(1 for _ in itertools.takewhile(lambda x: x[0] == x[1], zip(a[0][:limit], b[0][:limit]))) for a, b in itertools.pairwise(order)]  # noqa: B905
        assert [c for _, c in got] == [0, *shared]


def brute_removal(rows, n=100):
    seen, out = {}, {}
    data = {i: (t or "").encode() for i, t in rows}
    for i, b in data.items():
        for p in range(len(b) - n + 1):
            seen.setdefault(b[p : p + n], []).append((i, p))
    first = {k: min(v) for k, v in seen.items()}
    for i, b in data.items():
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - n + 1):
            if first[b[p : p + n]] < (i, p):
                gone[p : p + n] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[i] = (len(b), int(gone.sum()), int(np.sum(np.diff(np.append(0, gone.astype(int))) == 1)), hashlib.sha256(kept).hexdigest())
    return out


def test_substring_removal_against_brute_force(spark, odd, monkeypatch):
    rng = random.Random(5)
    line = "licensed under a rather common line of some eighty bytes that many hold" * 2
    base = [" ".join(rng.choices(WORDS, k=rng.randint(1, 120))) for _ in range(25)]
    texts = list(base)
    for _ in range(60):
        a, b = rng.choice(base), rng.choice(base)
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        texts.append(a[i : i + rng.randint(0, 300)] + rng.choice(WORDS) + line[: rng.randint(60, 142)] + b[j:] + "é" * rng.randint(0, 130))
    texts += ["ab" * 200, "ab" * 130, "x" * 99, "x" * 100, "x" * 101, None, ""]
    rows = list(enumerate(texts))
    want = brute_removal(rows)
    docs = docs_of(spark, [(i, t, None, None) for i, t in rows])
    for frequent in (1000, 3):
        got = by_id(substrings.remove_repeats(spark, docs.repartition(7), frequent))
        assert {k: tuple(list(v.values())[1:]) for k, v in got.items()} == want
    got = [r.asDict() for r in substrings.remove_repeats(spark, odd).collect()]
    assert len(got) == odd.count() and [r["n_removed"] for r in got if r["doc_id"] in (5, None)] == [0, 0, 0]
    assert [r["n_removed"] == r["n_bytes"] > 0 for r in got if r["doc_id"] == 6] == [True]
    assert substrings.remove_repeats(spark, docs.limit(0)).count() == 0


def test_anchor_windows_do_not_depend_on_blocks(monkeypatch):
    data = np.frombuffer(" ".join(random.Random(8).choices(WORDS, k=3000)).encode(), np.uint8)

    def all_windows():
        return np.concatenate([np.stack((a, o)) for _, _, a, o in substrings.windows(data)], axis=1)

    whole = all_windows()
    monkeypatch.setattr(substrings, "BLOCK", 1000)
    assert (all_windows() == whole).all() and whole.shape[1] == len(data) - 99


# --- decontamination


def test_leaks_with_substitutions_are_found_by_both_paths(spark, odd):
    rng = random.Random(6)
    items = [rng.choices(WORDS, k=n) for n in (15, 20, 40, 12, 9, 5)]
    plain = [rng.choices(WORDS, k=rng.randint(5, 200)) for _ in range(30)]
    texts = {i: " ".join(w) for i, w in enumerate(plain)}
    for i, item in enumerate(items):
        broken = [w if k % 8 != 3 else "zzz" for k, w in enumerate(item)]
        texts[100 + i] = " ".join([*plain[i], *item, *plain[i]]).upper()
        texts[200 + i] = "-- ".join([*plain[i], *broken, *plain[i]])
    texts[300] = " ".join(items[2][:10])  # too little of a long item
    benchmark = spark.createDataFrame([(i, " ".join(w), 1) for i, w in enumerate(items)] + [(99, None, 1)], "item_id long, text string, doc_id int")
    docs = docs_of(spark, [(i, t, None, None) for i, t in texts.items()])
    found = decontamination.find_leaks(spark, docs, benchmark)
    pairs = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert pairs == {(h + i, i) for h in (100, 200) for i in range(5)}  # the item of 5 words is too short
    again = decontamination.find_leaks(spark, docs, benchmark, broadcast_windows=0)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found.collect()))
    assert decontamination.find_leaks(spark, odd, benchmark).count() == 0
    assert decontamination.find_leaks(spark, docs.limit(0), benchmark).count() == decontamination.find_leaks(spark, docs, benchmark.limit(0)).count() == 0


def test_masks_hit_every_pattern_that_verification_accepts():
    for length in range(decontamination.LEAST, decontamination.WINDOW + 1):
        wrong = length - int(np.ceil(length * decontamination.SHARE))
        for places in itertools.combinations(range(length), wrong):
            line = "".join("0" if i in places else "1" for i in range(length))
            hits = [all(line[at + i] == "1" for i, c in enumerate(m) if c == "1") for m in decontamination.MASKS for at in range(length - len(m) + 1)]
            assert any(hits), line


def test_leaks_with_random_substitutions_against_brute_force(spark):
    rng = random.Random(14)
    items = {i: rng.choices(WORDS, k=rng.randint(9, 30)) for i in range(300)}
    words = {i: [*rng.choices(WORDS, k=5), *(w if rng.random() > 0.22 else "zz" for w in item), *rng.choices(WORDS, k=5)] for i, item in items.items()}
    want = set()
    for i, item in items.items():
        n = min(len(item), 15)
        for shift in range(-len(item), len(words[i])):
            agree = [0 <= j + shift < len(words[i]) and words[i][j + shift] == w for j, w in enumerate(item)]
            if any(sum(agree[s : s + n]) >= np.ceil(n * 0.8) for s in range(len(item) - n + 1)):
                want.add((i, i))
    docs = docs_of(spark, [(i, " ".join(w), None, None) for i, w in words.items()])
    found = decontamination.find_leaks(spark, docs, spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string"))
    assert 100 < len(want) < 300 and {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_short_items_and_scripts_without_spaces_leak(spark, tmp_path):
    short = {n: " ".join(f"q{n}x{k}" for k in range(n)) for n in range(1, 9)}
    chinese, thai = "床前明月光疑是地上霜举头望明月", "กขคงจฉชซฌญ"
    items = [*short.items(), (20, chinese), (21, thai), (22, "月光"), (23, "... !"), (24, None)]
    texts = {n: f"before {t.upper()}, after" for n, t in short.items()}
    texts |= {10 + n: f"before {t.replace(' ', ' and ')} after" for n, t in short.items() if n > 1}
    texts |= {40: f"李白说{chinese}低头思故乡", 41: f"ดต{thai}ถท", 42: "the " + chinese[:6] + "x" + chinese[7:]}
    docs = docs_of(spark, [(i, t, None, None) for i, t in texts.items()])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = {(n, n) for n in short} | {(40, 20), (40, 22), (41, 21), (42, 20), (42, 22)}
    for windows in (decontamination.BROADCAST_WINDOWS, 0):
        found = decontamination.all_leaks(spark, docs, benchmark, windows).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == want and len(found) == len(want)
        assert all(r["shift"] == 1 and r["matched"] == r["agreeing"] == r["item_words"] == r["item_id"] for r in found if r["doc_id"] < 9)
    exact(docs, "doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert decontamination.op4_decontamination(spark, str(tmp_path)).count() == len(want)


# --- embeddings


def test_vector_links_against_brute_force_also_in_blocks(spark):
    rng = np.random.default_rng(7)
    centre = rng.standard_normal((60, 16))
    rows = [(i, (centre[i % 60] + rng.normal(0, 0.06, 16)).tolist(), int(i % 60) % 3) for i in range(700)]
    rows += [(700 + i, (centre[0] + rng.normal(0, 0.04, 16)).tolist(), 0) for i in range(300)] + [(1000 + i, rows[5][1], 2) for i in range(40)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [None] * 16, 1), (2004, [], 1), (2005, rows[5][1], None), (2006, [1.0, 2.0], 2), (2007, [2.0, 4.0], 2), (None, rows[5][1], 2)]
    able = [(i, np.array(v), lab) for i, v, lab in rows if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: set() for i, *_ in rows}
    for (i, v, a), (j, w, b) in itertools.combinations(able, 2):
        if a == b and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98:
            links[i].add(j)
            links[j].add(i)
    root = {i: i for i in links if i is not None}
    while True:
        after = {i: min([r, *(root[j] for j in links[i])]) for i, r in root.items()}
        if after == root:
            break
        root = after
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, kept int")
    for block in (2048, 64):
        got = by_id(embeddings.link_vectors(spark, df.repartition(5), block=block), "vec_id")
        assert {i: r["n_links"] for i, r in got.items() if i is not None} == {i: len(x) for i, x in links.items() if i is not None}
        assert {i: r["component_id"] for i, r in got.items() if i is not None} == root
        assert got[None]["n_links"] == 0 and got[None]["component_id"] is None and got[None]["kept"] is False
    assert embeddings.link_vectors(spark, df.limit(0)).count() == 0


def test_more_vector_lengths_than_forests(spark):
    rows = [(2 * n + k, [1.0 + k] * n, 0) for n in range(1, 1003) for k in range(2)]
    rows += [(5000 + i, [1.0, float(i)], 0) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = by_id(embeddings.link_vectors(spark, df, trees=1), "vec_id")
    assert all(got[2 * n + k]["n_links"] == 1 and got[2 * n + k]["component_id"] == 2 * n for n in range(3, 1003) for k in range(2))


# --- language


def test_language_is_learned_without_the_held_out_fold(spark, odd):
    rng = random.Random(9)
    kinds = {"aa": "the and of to in was that".split(), "bb": "le la est une que dans pour".split(), "cc": "der die und das nicht ein".split()}
    rows = [(i, " ".join(rng.choices(kinds[k], k=rng.randint(1, 60))), k if i % 7 else None, None) for i in range(240) for k in [rng.choice(list(kinds))]]
    truth = {i: next(k for k, w in kinds.items() if t.split()[0] in w) for i, t, *_ in rows}
    got = by_id(language.identify(spark, docs_of(spark, rows)))
    assert np.mean([got[i]["lang_pred"] == truth[i] for i in truth if got[i]["held_out"]]) > 0.95
    assert all(0 < r["score"] <= 1 for r in got.values())
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    got = [r.asDict() for r in language.identify(spark, odd).collect()]
    assert len(got) == odd.count()
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in got if r["doc_id"] in (1, 2, 3, 7))
    nothing = docs_of(spark, [(1, "some text", None, None)])
    assert language.identify(spark, nothing).collect()[0]["lang_pred"] == "und" and language.identify(spark, nothing.limit(0)).count() == 0
    assert (language.grams("aé1b" * 400) == language.grams("aé1b" * 400)).all()


def test_many_languages_do_not_make_their_own_texts_rejected(spark):
    rng = random.Random(16)
    letters = "abcdefghijklmnopqrstuvwxyz"
    near = ["".join(rng.choices(letters, k=4)) for _ in range(40)]
    rows = [(i, " ".join(rng.choices(near, k=6) + [f"{letters[i % 12]}{letters[(i % 12) * 2]}"]), f"l{i % 12}", None) for i in range(360)]
    docs = exact(docs_of(spark, rows), "doc_id", "text", "lang")
    assert language.accept(spark, docs).count() == len(rows)
    assert language.accept(spark, docs, least=0.5).count() < len(rows)


def test_blocks_of_a_text_count_the_same_grams(monkeypatch):
    text = " ".join(random.Random(4).choices(WORDS, k=500)) + " ñandú 東京 "
    whole = language.grams(text)
    monkeypatch.setattr(language, "BLOCK", 17)
    assert (language.grams(text) == whole).all() and language.grams("12 .") is None


def test_training_rows_of_a_batch_are_made_sparse_one_by_one():
    texts = [f"text {i} " + WORDS[i % 400] for i in range(300)] + [None, "12 ."]
    batch = pa.record_batch([pa.array(["en"] * len(texts)), pa.array([1] * len(texts)), pa.array(texts)], names=["lang", "pick", "text"])
    language.grams("a")  # makes its table of letters
    tracemalloc.start()
    (rows,) = language._sparse(iter([batch]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 20 * language.DIMS * 8  # not one array of all buckets per text
    dense = [language.grams(t) for t in texts]
    for at, n, all_ in zip(rows["buckets"].to_pylist(), rows["counts"].to_pylist(), dense, strict=True):
        assert (at is None) == (n is None) == (all_ is None)
        if at is not None:
            assert (np.frombuffer(at, np.uint16) == np.flatnonzero(all_)).all() and (np.frombuffer(n, np.uint32) == all_[all_ > 0]).all()


# --- mixing


def test_targets_are_filled_and_no_document_is_taken_more_than_three_times(spark, odd):
    rng = random.Random(10)
    sizes = {"a": 40, "b": 400, "c": 5, None: 60, "é": 900}
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randint(0, 50))), None, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    got = [r.asDict() for r in mixing.mix(spark, docs_of(spark, rows)).collect()]
    total, size = sum(r["size"] for r in got), {s: sum(r["size"] for r in got if r["source"] == s) for s in sizes}
    target, open_ = {}, dict(zip(["a", "b", "c", "é", None], [5, 2, 1, 5, 2], strict=True))
    left = total
    while True:  # shares, the excess shared out again
        over = [s for s, w in open_.items() if left * w / sum(open_.values()) > 3 * size[s]]
        if not over:
            target |= {s: left * w / sum(open_.values()) for s, w in open_.items()}
            break
        for s in over:
            target[s] = 3 * size[s]
        left = total - sum(v for v in target.values())
        open_ = {s: w for s, w in open_.items() if s not in target}
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert all(abs(r["target"] - target[s]) < 1e-6 for r in mine) and abs(sum(r["taken"] for r in mine) - target[s]) <= 0.5
        assert all(r["taken"] <= 3 * r["size"] and len(r["positions"] or []) == -(-r["taken"] // max(r["size"], 1)) for r in mine)
    order = mixing.in_training_order(mixing.mix(spark, docs_of(spark, rows)))
    places = [r["position"] for r in order.collect()]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1
    assert sum(r["words"] for r in order.collect()) == sum(r["taken"] for r in got)
    odd_rows = mixing.mix(spark, odd).collect()
    assert len(odd_rows) == odd.count() and all(r["taken"] == 0 and r["positions"] is None for r in odd_rows if r["size"] == 0)
    assert mixing.mix(spark, odd.limit(0)).count() == 0


# --- html


def test_main_text_without_templates_and_boilerplate(spark):
    article = "<article><h1>Title &amp; more&#33;</h1><p>First\n  <b>bold</b> para<p>Second <a href=x>link</a>.<div class=box>Read our site rules</div><ul><li>one NUMBER<li>two</ul><section id=comments><p>Nice!</section></article>"
    around = '<header><h2>Site</h2></header><nav><ul><li>Menu</ul></nav><div class="cookie-notice">We use cookies</div><form><input>Go</form>{}<aside>Side</aside><footer>&copy;</footer><script>var a="<p>no</p>"</script>'
    rows = [(i, f"http://h.com/{i}", around.format(article.replace("NUMBER", str(i)))) for i in range(6)]
    plain = "<html><head><title>T</title></head><body><div>Welcome to the site</div><p>Only {}</p><div><p>Same everywhere</p></div><!-- c --><style>p</style></body>"
    rows += [(10 + i, f"http://p.com/{i}", plain.format(i)) for i in range(6)]
    rows += [(20, None, None), (21, "x", ""), (22, "http://z.com/", "<p>Cut <b>off <i"), (23, "http://z.com/", "a < b &lt; c &am"), (24, "http://z.com/", '<p>"quoted" <a href="unclosed>x</a>')]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")
    for hashes in (10_000, 0):
        got = by_id(html_text.main_text(spark, pages, broadcast_hashes=hashes), "page_id")
        assert got[0]["text"] == "Title & more!\nFirst bold para\nSecond link.\none 0\ntwo"
        assert [got[10 + i]["text"] for i in range(6)] == [f"Only {i}" for i in range(6)]
        assert (got[20]["text"], got[21]["text"], got[22]["text"], got[23]["text"]) == ("", "", "Cut off", "a < b < c &am")
        assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert html_text.main_text(spark, pages.limit(0)).count() == 0


def test_running_text_of_copies_and_repeated_passages_stays(spark):
    wrapped = "<div class=c><p>A passage that many hold</p></div><ul><li>same item</ul><table><tr><td>same cell</td></tr></table><section><p>Quoted</p></section>"
    links = "<ul><li><a href=/>Home</a><li><a href=/x>More</a></ul>"
    rows = [(i, f"http://h.com/{i}", f"<article><p>Own {i}</p>{wrapped}<div>box</div>{links}</article>") for i in range(8)]
    copy = "<body><nav>{}</nav><div><p>One story</p></div><div>told</div></body>"
    rows += [(20 + i, f"http://c.com/{i}", copy.format(i)) for i in range(6)] + [(30, "http://r.com/", copy)] * 6
    rows += [(40 + i, f"http://p.com/{i}", f"<body><div><p>Story {i}</p></div>{'<div><p>Passage</p></div>' if i < 6 else ''}<div><p>Rules</p></div></body>") for i in range(20)]
    rows += [(70 + i, f"http://a.com/{i}", f"<article><div><p>Copied story</p></div></article><nav>{i}</nav>") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for hashes in (10_000, 0):
        out = html_text.main_text(spark, pages.repartition(5), broadcast_hashes=hashes)
        assert out.count() == len(rows)
        got = {r["page_id"]: r["text"].split("\n") for r in out.collect()}
        assert all(got[i] == [f"Own {i}", "A passage that many hold", "same item", "same cell", "Quoted"] for i in range(8))
        assert all(got[i] == ["One story", "told"] for i in [*range(20, 26), 30])
        assert all(got[40 + i] == [f"Story {i}", *(["Passage"] if i < 6 else [])] for i in range(20))
        assert all(got[70 + i] == ["Copied story"] for i in range(6))


def test_templates_of_a_large_host_need_no_share_of_it(spark):
    rows = [(i, f"http://h.com/{i}", f"<article><p>Own {i}</p>{'<div>Notice</div>' if i < 8 else ''}</article>") for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for many, notice in ((8, []), (9, ["Notice"])):
        got = by_id(html_text.main_text(spark, pages, many_pages=many), "page_id")
        assert all(r["text"].split("\n") == [f"Own {i}", *(notice if i < 8 else [])] for i, r in got.items())


@pytest.mark.parametrize("html, want", [
    ('<div class="layout has-sidebar"><article><p>Real text.</p></article></div>', "Real text."),
    ('<div id="content" class="no-sidebar"><p>Real text.</p></div>', "Real text."),
    ('<article><p>One.</p><p class="share-prices">Two.</p><div class="related-work"><p>Three.</p></div></article>', "One.\nTwo.\nThree."),
    ('<article><p>One.</p><div class="share-buttons">S</div><div class="cookieNotice">C</div><div class="sidebar-left">L</div><ul class="nav-list"><li>N</ul></article>', "One."),
    ('<div class="page-header"><article><p>Inside.</p></article></div><div class="ad-slot-2">Buy</div>', "Inside."),
    ('<article><p>Text.</p><section id="comments"><article class="comment"><p>Nice</p></article></section></article>', "Text."),
    ('<article><div class="entry-header"><h1>Title</h1></div><p>Text.</p><div class="site-header">Site</div></article>', "Title\nText."),
    ('<div id="post-comments"><article class="comment"><p>Nice</p></article></div><p>Text.</p>', "Text."),
])
def test_class_names_say_what_an_element_is(html, want):
    assert html_text.Page(html, "h").text(frozenset(), frozenset()) == want


def test_hosts_that_begin_alike_have_their_own_templates():
    one, two = (html_text.Page("<div><p>x</p></div>", "a" * 64 + end).hashes() for end in "bc")
    assert one and not one & two


# --- minhash


def shingles_of(text, n):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


@pytest.mark.parametrize("block", [1024, 16])
def test_near_copies_against_brute_force(spark, monkeypatch, block):
    rng = random.Random(11)
    monkeypatch.setattr(minhash, "BLOCK", block)
    base = [rng.choices(WORDS, k=rng.randint(1, 150)) for _ in range(40)] + [rng.choices(WORDS, k=90)]
    texts = [" ".join(b) for b in base]
    for k in range(260):
        words = list(base[-1] if k < 160 else rng.choice(base))
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        texts.append(rng.choice([" ", "\n"]).join(words).replace("w", rng.choice("wW")))
    rows = [*enumerate(texts), (900, None), (901, ""), (902, "  "), (903, "Word"), (904, "word"), (905, texts[0]), (905, texts[0]), (None, texts[0])]
    sets = {i: shingles_of(t, 2) for i, t in rows if i is not None}
    root = {i: i for i in sets}
    linked = [(i, j) for i, j in itertools.combinations(sets, 2) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    for _ in range(20):
        for i, j in linked:
            root[i] = root[j] = min(root[i], root[j])
    got = [r.asDict() for r in minhash.near_duplicates(spark, docs_of(spark, [(i, t, None, None) for i, t in rows]), width=2).collect()]
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got if r["doc_id"] is not None} == {i: (len(s), root[i], root[i] == i) for i, s in sets.items()}
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, False)]


def test_sketch_estimates_are_close_at_high_similarity():
    rng = np.random.default_rng(12)
    for share in (0.8, 0.9, 0.98):
        both = rng.integers(0, 2**63, int(2000 * share)).astype(np.uint64)
        own = [rng.integers(0, 2**63, (2000 - len(both)) // 2).astype(np.uint64) for _ in range(2)]
        a, b = (np.frombuffer(minhash.odd_sketch(minhash.minhash(minhash.mixed(np.append(both, o)))), np.uint8) for o in own)
        assert abs(minhash.sketch_similarity(np.bitwise_count(a ^ b).sum()) - share) < 0.08


def test_blocks_decide_links_and_yield_forests():
    """80 texts, each pair of them nearly similar or similar: fewer pairs than rows, the links' components, whatever the batches."""
    rng = np.random.default_rng(13)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    sets = [np.unique(np.append(np.delete(base, rng.choice(300, k, replace=False)), rng.integers(0, 2**63, k).astype(np.uint64))) for k in rng.integers(8, 30, 80)]
    values = [minhash.minhash(x) for x in sets]
    bands = [minhash.band_keys(v).tolist() for v in values]
    rows = []
    for band in sorted({b for of in bands for b in of}):
        rows += [(band, "-/0/-/0", True, i, i, bands[i], minhash.odd_sketch(values[i]), sets[i].tobytes()) for i in range(80) if band in bands[i]]
    names = ["band", "meeting", "side", "doc_id", "component", "bands", "sketch", "hashes"]
    whole = pa.Table.from_pylist([dict(zip(names, r)) for r in rows])
    linked = {(i, j) for i, j in itertools.combinations(range(80), 2) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j])) and set(bands[i]) & set(bands[j])}
    assert 0 < len(linked) < 80 * 79 // 2

    def classes(pairs):
        root = list(range(80))
        for _ in range(80):
            for i, j in pairs:
                root[i] = root[j] = min(root[i], root[j])
        return root

    for size in (7, 100, len(rows)):
        out = pa.Table.from_batches(minhash._grouped(minhash._links_across(80), "band", "meeting")(iter(whole.to_batches(max_chunksize=size))))
        pairs = list(zip(out["a"].to_pylist(), out["b"].to_pylist()))
        assert set(pairs) <= linked and len(pairs) < len(rows) and classes(pairs) == classes(linked)


def test_no_documents_no_groups(spark, odd):
    assert minhash.near_duplicates(spark, odd.limit(0)).count() == 0


# --- licenses


def test_license_places_and_labels(spark, odd):
    rows = [
        (1, "Released under the MIT License. Under the MIT-license again!", None, None),
        (2, "This work is licensed under the GNU General Public License, version 3.", None, None),
        (3, "see the mit and the license of version 2", None, None),
        (4, "Licensed under CC BY-NC 4.0 or the Apache License,\nVersion 2.0", None, None),
        (5, "Licensed under CC BY-SA 4.0", None, None),
        (6, "under the mít license", None, None),
    ]
    got = {i: tuple(list(r.values())[1:]) for i, r in by_id(licenses.scan_licenses(spark, docs_of(spark, rows))).items()}
    assert got[1] == (10, 2, 1, 5, "mit", "mit", 1.0)
    assert got[2] == (12, 0, None, None, "", "gpl-3", 1.0)
    assert got[3][1:6] == (0, None, None, "", "")
    assert got[4] == (14, 2, 2, 9, "apache-2,cc-by-nc", "apache-2,cc-by-nc", 1.0)
    assert got[5][1:6] == (0, None, None, "", "cc-by-sa") and got[6][1:6] == (0, None, None, "", "")
    rows = licenses.scan_licenses(spark, odd).collect()
    assert len(rows) == odd.count() and all(r["n_words"] == 0 and r["score"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert licenses.scan_licenses(spark, odd.limit(0)).count() == 0


def test_licenses_against_every_alignment(spark):
    """Edited texts in other words, found by the index as by trying every place of every template."""
    for t, phrases in enumerate(licenses._PHRASES):
        assert all(len(set(p)) > 1 and any(licenses._SPLIT[t][k : k + len(p)] == p for k in range(len(licenses._SPLIT[t]))) for p in phrases)
    rng = random.Random(10)
    common = [w.decode() for w in licenses.VOCABULARY] + WORDS
    rows = []
    for i in range(120):
        label, text, _ = licenses.TEMPLATES[i % len(licenses.TEMPLATES)]
        words = text.split()
        for _ in range(rng.choice([0, 0, 1, 2, len(words) // 4, len(words) // 2])):
            k = rng.randrange(len(words))
            words[k : k + rng.choice([0, 1, 1, 3])] = rng.choices(common, k=rng.choice([0, 1, 1, 5]))
            words = words or ["x"]
        rows.append((i, " ".join(rng.choices(common, k=rng.choice([0, 30])) + words + rng.choices(common, k=20)), None, None))
    got = by_id(licenses.scan_licenses(spark, docs_of(spark, rows)))
    some = 0
    for i, text, *_ in rows:
        words = licenses._words(pa.scalar(text.encode()))
        want, best = set(filter(None, got[i]["base_labels"].split(","))), 1.0 if got[i]["n_base"] else 0.0
        for t, (label, *_) in enumerate(licenses.TEMPLATES):
            for j, w in enumerate(licenses._SPLIT[t]):
                for k in [k for k, x in enumerate(words) if x == w] if any(w in p for p in licenses._PHRASES[t]) else []:
                    if like := licenses._matches(words, t, k, j):
                        want.add(label)
                        best = max(best, like)
        assert set(filter(None, got[i]["labels"].split(","))) == want, (i, text)
        assert got[i]["score"] <= best
        some += bool(want)
    assert 50 < some < 120
    rows = [(t, f"(c) 2020\n{text} end", None, None) for t, (_, text, _) in enumerate(licenses.TEMPLATES)]
    got = by_id(licenses.scan_licenses(spark, docs_of(spark, rows)))
    assert all(label in got[t]["labels"].split(",") for t, (label, *_) in enumerate(licenses.TEMPLATES))


def test_license_base_columns_by_sql(spark):
    rng = random.Random(11)
    parts = ["under the mit license", "Apache License\nversion-2", "cc by", "nc", "mit", "under the", "é", "x_2"]
    rows = [(i, None if i == 7 else " ".join(rng.choices(parts, k=rng.randrange(9)))) for i in range(150)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    phrases = " UNION ALL ".join(f"SELECT '{p}' AS p, '{label}' AS label" for p, label in licenses.BASE)
    want = con.execute(f"""
        WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
        p AS (SELECT string_split(p, ' ') AS p, label FROM ({phrases})),
        f AS (SELECT doc_id, label, i FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM w), p WHERE list_slice(w, i + 1, i + len(p)) = p)
        SELECT w.doc_id, len(w), count(i), min(i), max(i), coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') FROM w LEFT JOIN f USING (doc_id) GROUP BY ALL
    """).fetchall()
    got = licenses.scan_licenses(spark, spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted(map(tuple, got.collect())) == sorted(want)


# --- pipeline


def test_pipeline_stages_act_and_pass_columns(spark, odd, tmp_path):
    import corpus_pipeline

    rng = random.Random(13)
    passage = " ".join(rng.choices(WORDS, k=60))
    english = lambda n: " ".join(rng.choices("the and of to in was that it for with on as are this".split() + WORDS, k=n))
    rows = [(i, english(80), "en", "s") for i in range(40)]
    rows += [(100, rows[3][1], "en", "s"), (101, english(30) + " " + passage, "en", "s"), (102, passage + " " + english(30), "en", "t"), (103, "123 456", "en", "t"), (None, english(50), "en", "t")]
    leak = rng.choices(WORDS, k=30)
    rows += [(104, english(20) + " " + " ".join(leak) + " " + english(20), "en", "t")]
    path = str(tmp_path)
    exact(docs_of(spark, rows), "doc_id", "text", "lang", "source").withColumn("n_chars", F.length("text")).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(leak))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        docs = corpus_pipeline.Stage(spark, "test")(out, name)
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(seen["language"]) == {r[0] for r in rows} - {103}
    assert set(seen["near_copies"]) == set(seen["language"]) - {100}
    assert passage in seen["repeats"][101] and passage not in seen["repeats"][102] and len(seen["repeats"][102]) > 100
    assert set(seen["leaks"]) == set(seen["near_copies"]) - {104}
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, path).collect()}
    assert ids and ids <= set(seen["leaks"])


def test_pipeline_decides_by_row_where_ids_are_shared_or_null(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(15)
    text = lambda: " ".join(rng.choices(WORDS, k=80))
    first, second, third, leak = text(), text(), text(), rng.choices(WORDS, k=30)
    leaked = " ".join([*rng.choices(WORDS, k=20), *leak])
    rows = [(1, first, "en", "a"), (2, first + " more", "en", "a"), (2, second, "en", "a"), (3, third, "en", "b"), (3, third, "en", "b"), (None, leaked, "en", "b"), (None, text(), "en", "b"), (4, leaked, "en", "b"), (4, text(), "en", "b")]
    spark.createDataFrame([(1, " ".join(leak))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = docs_of(spark, rows)
    out = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    got = [(r[0], r[1]) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(i, t) for i, t, *_ in [rows[0], *rows[2:4], *rows[5:]]], key=str)
    out = corpus_pipeline.drop_leaks(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert sorted(((r[0], r[1]) for r in out.collect()), key=str) == sorted([(i, t) for i, t, *_ in [*rows[:5], rows[6], rows[8]]], key=str)
