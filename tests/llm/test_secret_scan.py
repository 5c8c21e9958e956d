import hashlib
import random
import re
import string

from spendwatch.llm import secret_scan

PATTERNS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def brute(text):
    spans = [(m.start(), rank, m.end(), kind) for rank, (kind, p, group, least) in enumerate(PATTERNS)
             for m in p.finditer(text or "") if len(m[group]) >= least]
    return sorted(spans)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["password=", "TOKEN: ", "secret", ": token: abcdefgh", "api_key='", "x" * 7, "AKIA" + "Z9" * 8, "AKIAAKIA" + "A" * 12,
             "0123456789abcdef" * 2, "de", " ", "\n", "é", "𝄞", "=", "abc.def-ghi", "apikey=short", "ſecret=abcdefgh"]
    texts = ["".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(200)]
    texts += [None, "", "password=abcdef " * 2000, "nothing here"]
    rows = {r.doc_id: r for r in secret_scan.report(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        spans = brute(text)
        assert [rows[i].n_assign, rows[i].n_access, rows[i].n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert rows[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in rows[i].spans.split(",") if s and not s.startswith("random")] == ([joined] if len(spans) == 1 else joined.split(",") if joined else [])


def test_battery_finds_random_tokens_and_leaves_words(spark):
    rng = random.Random(7)
    secrets = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(48)) for _ in range(20)]
    secrets += ["".join(rng.choice("0123456789ABCDEF") for _ in range(48)) for _ in range(20)]
    plain = ["ThisIsAnOrdinaryIdentifierNameOfTheLibrary2", "path/to/some/module/with/many/parts", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1B",
             "1234567890123456789012345678", "ABABABABABABABAB12121212121212", "the-quick-brown-fox-jumps-over-the-lazy-dog"]
    rows = secret_scan.report(frame(spark, [f"see {s} there" for s in secrets + plain])).orderBy("doc_id").collect()
    assert sum(r.n_random for r in rows[: len(secrets)]) >= 0.8 * len(secrets)
    assert all(r.n_random == 0 for r in rows[len(secrets):])
    hit = next(r for r in rows if r.n_random)
    assert hit.spans == "random:4:52"


def test_redaction_replaces_spans_and_keeps_other_columns(spark):
    docs = spark.createDataFrame([(1, "a password=abcdefgh b", "x"), (2, None, "y"), (3, "plain", None),
                                  (4, "token=" + "0123456789abcdef" * 2, "z")], "doc_id long, text string, base string")
    out = {r.doc_id: r for r in secret_scan.redact(docs.withColumnRenamed("base", "lang")).collect()}
    assert [out[i].text for i in (1, 2, 3, 4)] == ["a [SECRET] b", "", "plain", "[SECRET]"]
    assert out[1].lang == "x"


def test_empty_table_and_extra_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, spans string, base int, size int")
    assert secret_scan.report(docs).count() == 0
    docs = spark.createDataFrame([(1, "password=abcdefgh", "s", 1)], "doc_id long, text string, spans string, base int")
    assert secret_scan.report(docs).first().spans == "assign:0:17"
    assert secret_scan.redact(docs).first().base == 1


def test_very_long_tokens_and_very_many_spans(spark):
    rng = random.Random(11)
    alphabet = string.ascii_letters + string.digits + "+/"
    long = ["".join(rng.choices(alphabet, k=n)) for n in (1_300, 50_000)] + ["A1" * 30_000]
    lines = "\n".join(f"{rng.getrandbits(128):032x}  {''.join(rng.choices(alphabet, k=40))}" for _ in range(3_000))
    rows = secret_scan.report(frame(spark, [f"x {t} y" for t in long] + [lines])).orderBy("doc_id").collect()
    assert [r.spans for r in rows[:3]] == ["random:2:1302", "random:2:50002", ""]
    assert rows[3].n_hex == 3_000
    # Every line has 32 hex digits and, two spaces on, a token of 40; a hex span is never found twice.
    places = {f"{a}:{a + 40}" for a in range(34, len(lines), 75)}
    found = [s.removeprefix("random:") for s in rows[3].spans.split(",") if s.startswith("random:")]
    assert found and len(found) == rows[3].n_random and set(found) <= places


def test_redaction_equals_cutting_the_reported_spans(spark):
    rng = random.Random(12)
    words = ["password=", "token: ", "0123456789abcdef" * 2, "AKIA" + "Z9" * 8, "secret:AKIA" + "Q7" * 9, " ", "é", "𝄞", "\n", "ab", "".join(
        rng.choices(string.ascii_letters + string.digits, k=44))]
    texts = ["".join(rng.choice(words) for _ in range(rng.randrange(120))) for _ in range(120)] + ["", None]
    docs = frame(spark, texts)
    spans = {r.doc_id: [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s] for r in secret_scan.report(docs).collect()}
    for r in secret_scan.redact(docs).collect():
        text, at, expected = texts[r.doc_id] or "", 0, ""
        for a, b in spans[r.doc_id]:
            expected += text[at:a] + "[SECRET]" if a >= at else ""
            at = max(at, b)
        assert r.text == expected + text[at:]


WORDS = ("the quick brown fox module path with many parts some library name index config value server client handler utils common "
         "data request response manager service factory builder account invoice").split()


def ordinary(rng):
    """Paths, identifiers, slugs and constants of 20 characters or more."""
    while True:
        kind, pick = rng.randrange(4), [rng.choice(WORDS) for _ in range(6)]
        text = ("/".join(pick), "".join(w.capitalize() for w in pick[:5]) + str(rng.randrange(10)), "-".join(pick[:5]) + f"-{rng.randrange(2100)}",
                "_".join(w.upper() if rng.random() < 0.3 else w for w in pick[:5]) + f"/v{rng.randrange(9)}")[kind]
        if len(text) >= 20:
            return text[:rng.choice([28, 34, 60])]


def test_recall_by_length_and_neighbours(spark):
    """A random key among ordinary tokens of the same document."""
    rng = random.Random(21)
    alphabets = [string.ascii_letters + string.digits + "+/", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEF"]
    cases, texts = [], []
    for length, many in ((20, 0), (20, 100), (32, 0), (32, 1), (32, 20), (32, 100), (40, 20), (40, 100), (64, 100)):
        for k in range(60):
            key = "".join(rng.choice(alphabets[k % 3]) for _ in range(length))
            tokens = [ordinary(rng) for _ in range(many)]
            place = rng.randrange(many + 1)
            before = " ".join(tokens[:place]) + (" " if place else "")
            texts.append(before + key + "".join(" " + t for t in tokens[place:]))
            cases.append(((length, many), f"random:{len(before)}:{len(before) + length}"))
    rows = {r.doc_id: r.spans.split(",") for r in secret_scan.report(frame(spark, texts)).collect()}
    hits, wrong, others = {}, 0, 0
    for i, ((length, many), span) in enumerate(cases):
        hits.setdefault((length, many), []).append(span in rows[i])
        wrong += sum(s.startswith("random") and s != span for s in rows[i])
        others += many
    for (length, many), found in hits.items():
        assert sum(found) >= (0.9 if length >= 32 else 0.65) * len(found), (length, many, sum(found))
    assert wrong <= 0.05 * others
