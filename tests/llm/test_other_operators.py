import gzip
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendwatch.llm import chat_format, decontam, quality, toxicity, url_filter, warc
from spendwatch.llm.common import table
from spendwatch.llm.queries import queries
from tests.conftest import SF_MID


# --- chat formatting -------------------------------------------------------

def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place int")


def test_examples_are_prefixes_with_one_trainable_reply(spark):
    rows = [(1, 0, "user", "a <b>", 0), (1, 1, "assistant", "</turn>\n\\x", 0), (1, 2, None, None, 0), (1, 3, "assistant", "", 0),
            (2, 0, "user", "alone", 0), (None, 5, "assistant", "first", 0), (1, 1, "assistant", "</turn>\n\\x", 0)]
    formatted = chat_format.format_turns(turns(spark, rows))
    stream = {}
    for r in formatted.orderBy("conv_id", "place").collect():
        assert r.start == len(stream.get(r.conv_id, ""))
        stream[r.conv_id] = stream.get(r.conv_id, "") + r.formatted
    expanded = {(r.conv_id, r.place): r for r in chat_format.expand(formatted).collect()}
    spans = {(r.conv_id, r.place): r for r in chat_format.examples(formatted).collect()}
    assert set(expanded) == set(spans) == {(1, 1), (1, 2), (1, 4), (None, 0)}
    for key, e in expanded.items():
        s = spans[key]
        assert e.context == stream[key[0]][:s.context_end]
        assert e.target == s.target == stream[key[0]][s.target_start:s.target_end]
    assert chat_format.unescape(expanded[1, 1].target) == "</turn>\n\\x"
    assert "</turn>" not in expanded[1, 1].target
    assert chat_format.digests(chat_format.format_turns(turns(spark, []))).count() == 0


def test_escape_is_reversible():
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice("\\<>lg/turn é\n") for _ in range(rng.randrange(30)))
        assert chat_format.unescape(chat_format.escape(text)) == text
        assert chat_format.parse_turn(f"<turn role=u>{chat_format.escape(text)}</turn>\n") == ("u", text)


# --- url filter ------------------------------------------------------------

def rule_by_hand(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else None


def test_urls_and_rules_equal_plain_python(spark):
    urls = [None, "", "no scheme/net/", "http://a.NET/x", "http://net/", "http://net", "x://y://z/net/", "http://example.net/en/1?q=/de/", "//x",
            "http://Example.Net/EN/", "http://sub.example.com/de/", "http://notexample.com/de/", "http://org/fr/#a", "http://a.org?/fr/",
            "http://É.net/é", "http://a\n.net/x\ny", "http://example.com/de"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rows = {r.page_id: r for r in url_filter.judge(pages).collect()}
    for i, u in enumerate(urls):
        host, path, rule = rule_by_hand(u)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule[0] if rule else None), u
        assert rows[i].verdict == (rule[1] if rule else rows[i].verdict)
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_templates_with_mostly_blocked_examples_are_rejected(spark):
    rules = [("block", "shop.example", f"/spam/{k}") for k in range(1, 10)] + [("allow", "shop.example", "/news/")]
    urls = [f"http://shop.example/spam/{k}" for k in range(0, 100)] + [f"http://shop.example/news/n{k}" for k in range(20)]
    urls += [f"http://shop.example/tag/{'abcdefghijklmnopqrstuvwxyz'[k]}/x" for k in range(26)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = {urls[r.page_id]: r for r in url_filter.judge(pages, rules).collect()}
    assert rows["http://shop.example/spam/0"].rule is None
    assert rows["http://shop.example/spam/0"].verdict == "block"
    assert rows["http://shop.example/tag/a/x"].template == "/tag/*/x"
    assert rows["http://shop.example/tag/a/x"].verdict == "allow"


def templates_by_hand(urls, rules):
    """Verdict, template and purity of each url, tree by tree."""
    def rule(host, path):
        fits = [(len(h + p), v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[1] if fits else None

    rows = []
    for u in urls:
        host, path, _ = rule_by_hand(u)
        segs = [re.sub(r"\.[A-Za-z]{2,5}$", "", x) for x in path.split("/") if x]
        form = tuple("*" if re.search(r"[0-9]|^[0-9a-fA-F-]{16,}$|^.{40,}$", x) else x for x in segs)[:8]
        rows.append((host, rule(host, path), form))
    shape = {(h, f): f for h, _, f in rows}
    deepest = max((len(f) for f in shape.values()), default=0)
    for depth in range(deepest):
        kinds = defaultdict(Counter)
        for h, _, f in rows:
            if len(f) > depth:
                kinds[h, shape[h, f][:depth]][shape[h, f][depth]] += 1
        wide = {k for k, c in kinds.items() if len(c) > 16 and len(c) * 4 > sum(c.values())}
        shape = {(h, f): s[:depth] + ("*",) + s[depth + 1:] if len(s) > depth and (h, s[:depth]) in wide else s for (h, f), s in shape.items()}
    for depth in range(deepest):
        cells = defaultdict(Counter)
        for h, _, f in rows:
            s = shape[h, f]
            if len(s) > depth and s[depth] != "*":
                cells[h, s[:depth]][s[depth], s[depth + 1:]] += 1
        names = {}
        for node, c in cells.items():
            pool, own = Counter(), Counter()
            for (child, tail), n in c.items():
                pool[tail] += n
                own[child] += n
            total, df = sum(pool.values()), len(pool) - 1
            limit = df * (1 - 2 / (9 * df) + 2.326 * math.sqrt(2 / (9 * df))) ** 3 if df else 0
            alike = sorted(x for x in own if sum((c[x, t] - own[x] * pool[t] / total) ** 2 / (own[x] * pool[t] / total) for t in pool) <= limit + 1e-6)
            if len(alike) > 1:
                names |= {(node, x): alike[0] + "+" for x in alike}
        shape = {(h, f): s[:depth] + (names.get(((h, s[:depth]), s[depth]), s[depth]),) + s[depth + 1:] if len(s) > depth else s for (h, f), s in shape.items()}
    seen = defaultdict(Counter)
    for h, v, f in rows:
        for k in range(1, len(shape[h, f]) + 1):
            seen[h, shape[h, f][:k]][v] += 1
    out = []
    for h, v, f in rows:
        s = shape[h, f]
        found = [c for k in range(len(s), 0, -1) if (c := seen[h, s[:k]])["block"] + c["allow"]]
        purity = (found[0]["block"] + 1) / (found[0]["block"] + found[0]["allow"] + 2) if found else None
        out.append((v or ("block" if purity is not None and purity >= 0.8 else "allow"), "/" + "/".join(s), purity))
    return out


def test_templates_and_purities_equal_a_tree_by_hand(spark):
    rng = random.Random(12)
    rules = [("block", "a.com", "/de/"), ("block", "a.com", "/shop/spam"), ("allow", "a.com", "/news/"), ("block", "b.org", "/x/y/"), ("allow", "b.org", "/x/z")]
    words = ["de", "en", "shop", "news", "x", "y", "z", "spam", "item", "2024", "a7", "index.html"]
    urls = [f"http://{rng.choice(['a.com', 'm.a.com', 'b.org', 'c.net'])}/" + "/".join(rng.choice(words) for _ in range(rng.randrange(5))) for _ in range(600)]
    urls += [f"http://a.com/tag/{''.join(rng.choice('abcdef') for _ in range(4))}/x" for _ in range(40)] + [f"http://a.com/{lang}/{k}" for lang in ("de", "en", "fr") for k in range(9)]
    urls += ["http://a.com/" + "/".join(["deep"] * 30), None, "http://a.com", "http://a.com//"]
    pages = spark.createDataFrame([(i, u, "v", 0.5, ["s"]) for i, u in enumerate(urls)], "page_id long, url string, verdict string, purity double, form array<string>")
    got = sorted((r.page_id, r.verdict, r.template, r.purity) for r in url_filter.judge(pages, rules).collect())
    want = templates_by_hand(urls, rules)
    assert [(v, t) for _, v, t, _ in got] == [(v, t) for v, t, _ in want]
    assert all((g is None) == (w is None) and (g is None or abs(g - w) < 1e-12) for (*_, g), (*_, w) in zip(got, want))
    assert {v for (v, _, p) in want if p is not None} == {"block", "allow"}


def test_the_query_judges_urls_without_a_rule_by_evidence(spark):
    rows = url_filter.judge(table(spark, SF_MID, "pages")).collect()
    free = [r for r in rows if r.rule is None]
    assert sum(r.purity is not None for r in free) > 0.3 * len(free) and {r.verdict for r in free} == {"block", "allow"}
    urls = {r.page_id: r.url for r in table(spark, SF_MID, "pages").collect()}
    want = templates_by_hand([urls[r.page_id] for r in rows], url_filter.RULES)
    assert [(r.verdict, r.template) for r in rows] == [(v, t) for v, t, _ in want]


# --- warc ------------------------------------------------------------------

def test_round_trip_with_magic_inside_payloads(spark):
    magic = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    big = "x" * 990 + magic
    rows = [(1, "http://a", big), (2, "http://b\r\nContent-Length: 1", big), (9, None, big), (4, "u", None), (5, "u", "short"), (6, "u", "short"),
            (7, "u", magic * 3), (9, None, big), (None, "u", "é" * 700), (8, "u", "é" * 700)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload_bytes int").repartition(3)
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect())
    size = len(big)
    assert got == sorted([("1", size, "revisit", 9), ("2", size, "revisit", 9), ("9", size, "response", None), ("9", size, "response", None),
                          ("4", 0, "response", None), ("5", 5, "response", None), ("6", 5, "response", None), ("7", 3 * len(magic), "response", None),
                          ("None", 1400, "revisit", 8), ("8", 1400, "response", None)])
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_pointer_jumping_equals_following_the_chain(spark, tmp_path):
    rng = random.Random(3)
    for _ in range(200):
        offsets = np.array(sorted({0, *(rng.randrange(60) for _ in range(12))}))
        successors = np.array([rng.choice([-1, o + rng.randrange(1, 20), *offsets[offsets > o][:2]]) for o in offsets])
        at, seen = 0, set()
        by = dict(zip(offsets.tolist(), successors.tolist()))
        while at in by and by[at] >= 0:
            seen.add(at)
            at = by[at]
        assert set(offsets[warc.reachable(offsets, successors)].tolist()) == seen
    plain = b"".join(b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(p), p) for p in (b"a", b"WARC/1.0\r\n", b""))
    (tmp_path / "a.warc").write_bytes(plain)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(plain))
    (tmp_path / "c.warc").write_bytes(b"junk" + plain)
    (tmp_path / "d.warc").write_bytes(plain[:-3])
    found = warc.read_records(spark, str(tmp_path), with_payload=True).collect()
    count = {name: [bytes(r.payload) for r in found if r.archive.endswith(name)] for name in ("a.warc", "b.warc.gz", "c.warc", "d.warc")}
    assert count["a.warc"] == count["b.warc.gz"] == [b"a", b"WARC/1.0\r\n", b""]
    assert count["c.warc"] == [] and count["d.warc"] == [b"a", b"WARC/1.0\r\n"]


# --- decontamination -------------------------------------------------------

def test_containment_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(200)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [say(rng.randrange(1, 60)) for _ in range(40)]
    docs = []
    for i in range(150):
        w = say(rng.randrange(0, 400))
        for item in rng.sample(items, rng.choice([0, 0, 1, 3, 30])):
            part = list(item)
            for _ in range(rng.choice([0, 0, 1, 3])):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(w) + 1)
            w[at:at] = part
        docs.append((i, " ".join(w)))
    docs += [(500, None), (501, " "), (502, " ".join(items[0]).upper()), (502, "x")]
    items = [(k, " ".join(w)) for k, w in enumerate(items)] + [(900, None), (901, "two words"), (901, "two words")]
    docs.append((503, "Two Words"))

    def grams(text):
        w = (text or "").lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    expected = {(d, k, len(grams(q)), len(grams(q) & grams(t))) for d, t in docs for k, q in items
                if grams(q) and 100 * len(grams(q) & grams(t)) >= 80 * len(grams(q))}
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, keys string")
    q = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r)[:4] for r in decontam.contained_items(d, q).collect()}
    assert got == expected
    assert decontam.contained_items(d.limit(0), q).count() == 0
    assert decontam.contained_items(d, q.limit(0)).count() == 0


def test_a_phrase_that_all_items_share_makes_no_candidates(spark):
    phrase = "which of the following is true"
    items = spark.createDataFrame([(k, phrase + "".join(f" i{k}x{j}" for j in range(40))) for k in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(k, f"{phrase} or not d{k}") for k in range(60)] + [(99, phrase + "".join(f" i7x{j}" for j in range(40)))],
                                 "doc_id long, text string")
    described = decontam.describe_items(items, 80, 1e-6).cache()
    found = decontam.project(docs, decontam.bitmap_of(described))
    assert found.count() == 61
    pairs = decontam.candidates(found, described).collect()
    assert (99, 7) in [tuple(r) for r in pairs]
    assert {r.doc_id for r in pairs} == {99}
    assert [tuple(r)[:2] for r in decontam.contained_items(docs, items).collect()] == [(99, 7)]


@pytest.mark.parametrize("size,largest", [(1, 1), (40, 63), (40, 255), (3, 1 << 20)])
def test_band_rows_reach_the_miss_probability(size, largest):
    rows = decontam.band_rows(size, largest, 80, 1e-6)
    shared = -(-size * 80 // 100)
    similarity = shared / (max(largest, shared) + size - shared)
    assert rows == 0 or (1 - similarity ** rows) ** (64 // rows) <= 1e-6


# --- quality ---------------------------------------------------------------

def repeated(words, k=8):
    at = {}
    for i in range(len(words) - k + 1):
        at.setdefault(tuple(words[i:i + k]), []).append(i)
    return len({j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + k)})


def test_base_counts_equal_plain_python(spark):
    import re
    rng = random.Random(6)
    texts = [None, "", " \n\t ", "a b c d e f g h " * 3, "x\ny\n x\nx\n\n\n", "a" * 9 + " # $ | <>", "one " * 500]
    texts += ["".join(rng.choice(["a ", "b ", "é\n", "c\u00a0d ", "# ", "a b c d e f g h i ", "\x0b"]) for _ in range(rng.randrange(80))) for _ in range(80)]
    docs = spark.createDataFrame([(i, t, "en", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_words int")
    rows = {r.doc_id: r for r in quality.measure(docs).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        expected = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), repeated(w))
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected, t
        assert r.base_failed == (len(w) < 20 or 100 * expected[4] > 30 * len(w))


def test_cutoffs_hold_the_risk_and_reject_bad_documents(spark):
    rng = random.Random(8)
    text = lambda marks: " ".join(f"w{rng.randrange(10**6)}" + ("#####" if rng.random() < marks else "") for _ in range(40))
    rows = [(i, text(0.0 if i % 5 else 0.7), "en", int(i % 5 > 0)) for i in range(4000)] + [(9000 + i, text(0.7), None, 0) for i in range(20)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(1, None), (77777, 1), (5, 0)], "doc_id long, quality int")
    out = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert len(out) == len(rows)
    assert sum(out[r[0]].kept for r in rows if r[2] and r[3]) >= 0.99 * 3200
    assert sum(not out[r[0]].kept for r in rows if r[2] and not r[3]) >= 700
    assert all(out[9000 + i].kept for i in range(20))  # too few labels in this stratum
    assert quality.judge(docs.limit(0), labels).count() == 0
    assert quality.judge(docs.limit(3), labels.limit(0)).where("kept").count() == 3


# --- toxicity --------------------------------------------------------------

def test_block_index_is_exact():
    rng = np.random.default_rng(3)
    vectors = (rng.random((700, 30)) * (rng.random((700, 30)) < 0.2)).astype(np.float32)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    index = toxicity.BlockIndex(vectors, np.ones(700), np.zeros(700))
    for _ in range(50):
        terms = np.sort(rng.choice(30, 5, replace=False))
        weights = rng.random(5).astype(np.float32)
        found, cosines = index.nearest(terms, weights, 10)
        every = index.vectors[:, terms] @ weights
        best = np.sort(every[every > 0])[::-1][:10]
        assert np.allclose(cosines, best, atol=1e-5)
        assert np.allclose(every[found], cosines, atol=1e-6)


def test_held_out_accuracy_and_no_label_leak(spark):
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    out = toxicity.score(docs, labels)
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.toxic for r in rows) >= 0.93 * len(rows)
    assert out.where("score < 0 or score > 1 or predicted <> int(score >= 0.5)").count() == 0
    flipped = labels.withColumn("toxic", F.when(toxicity.fold(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert out.exceptAll(toxicity.score(docs, flipped)).count() == 0


def test_toxicity_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (None, "x y", 0.1), (3, "", 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (2, 1)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score(docs, labels).collect()] == [0.0, 0.0, 0.0]
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))


def test_neighbours_are_taken_over_whole_vectors(spark):
    """Seven examples of each label: no word separates them beyond a fixed significance."""
    rng = random.Random(9)
    say = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(30))
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5][:14]
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0][:4]
    rows = [(i, say() + (" vile" if k % 2 else " kind")) for k, i in enumerate(ids)] + [(i, say() + (" vile" if k % 2 else " kind")) for k, i in enumerate(held)]
    docs = spark.createDataFrame(rows + [(900, rows[0][1]), (901, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert [out[i].predicted for i in held] == [0, 1, 0, 1]
    assert all(out[i].n_neighbours >= 7 for i in held)
    assert out[900].top_cosine == pytest.approx(1, abs=1e-5) and out[901].n_neighbours == 0
    # Every word counts, also those that one example alone has.
    assert out[900].evidence_ids[0] == ids[0] and out[901].evidence_ids == []
    assert all(set(r.evidence_ids) <= set(ids) and r.evidence_cosines == sorted(r.evidence_cosines, reverse=True) for r in out.values())
    assert out[900].n_neighbours >= 7 and out[ids[1]].top_cosine == pytest.approx(1, abs=1e-5)


def test_digests_take_their_loss_from_the_examples(spark, monkeypatch):
    rows = [(1, 0, "user", "a", 0), (1, 1, "assistant", "b<c", 0), (2, 0, "assistant", "dé𝄞", 0), (2, 1, "assistant", "", 0)]
    formatted = chat_format.format_turns(turns(spark, rows))
    assert {r.conv_id: r.loss_chars for r in chat_format.digests(formatted).collect()} == {1: 3, 2: 3}
    own = chat_format.with_examples
    monkeypatch.setattr(chat_format, "with_examples", lambda f: own(f).withColumn("example", F.when(F.col("conv_id") == 1, F.col("example"))))
    assert {r.conv_id: r.loss_chars for r in chat_format.digests(formatted).collect()} == {1: 3, 2: 0}


def test_examples_carry_their_whole_prefix_and_digests_read_it(spark, monkeypatch):
    rows = [(1, k, "assistant" if k % 2 else "user", f"<{k}é>" * k, 0) for k in range(9)] + [(2, 0, "assistant", "x", 0)]
    monkeypatch.setattr(chat_format, "BATCH_CHARS", 40)
    formatted = chat_format.format_turns(turns(spark, rows))
    streams = {}
    for r in chat_format.with_examples(formatted).collect():
        before = streams.get(r.conv_id, "")
        streams[r.conv_id] = before + r.formatted
        assert (r.example is None) == (r.target_start is None)
        if r.example is not None:
            assert r.example.context + r.example.target + chat_format.TAIL == streams[r.conv_id]
            assert r.example.context.startswith(before) and len(r.example.context) == r.example.context_end
    own = chat_format.with_examples
    short = F.struct(F.lit("").alias("context"), F.col("example.target").alias("target"))
    monkeypatch.setattr(chat_format, "with_examples", lambda f: own(f).withColumn("example", F.when(F.col("example").isNotNull(), short)))
    with pytest.raises(Exception, match="does not fit its stream"):
        chat_format.digests(formatted).collect()
