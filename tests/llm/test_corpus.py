"""Personal data, spelling variants and collocations."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from support import database, rows_of, rows_of_sql

from pyrocell.llm import personal_data, phrases, queries, spelling
from pyrocell.llm.common import read

DOCUMENTS = "doc_id long, text string, lang string, n long, spans string, word string"


def documents(spark, texts, langs=None):
    """Rows with columns whose names clash with those of the operators."""
    langs = langs or ["en"] * len(texts)
    return spark.createDataFrame([(i, t, lang, 7, "x", "y") for i, (t, lang) in enumerate(zip(texts, langs, strict=True))], DOCUMENTS)


# Personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (2 if k % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute_base(text):
    only = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m) for m in EMAIL.finditer(text)]
    out += [("ip", m) for m in IP.finditer(text) if all(int(p.lstrip("0")[:4] or "0") <= 255 for p in m.group().split("."))]
    out += [("card", m) for m in CARD.finditer(text) if 12 <= len(only(m.group())) <= 19 and brute_luhn(only(m.group()))]
    out += [("phone", m) for m in PHONE.finditer(text) if 9 <= len(only(m.group())) <= 15]
    return sorted(((k, m.start(), m.end()) for k, m in out), key=lambda s: (s[1], ["email", "ip", "card", "phone"].index(s[0])))


def luhn_number(rnd, n):
    body = "".join(rnd.choice("0123456789") for _ in range(n - 1))
    return next(body + d for d in "0123456789" if brute_luhn(body + d))


EDGES = [
    None, "", "@", "a@", "@b.c", "a@b", "a@b.", "a@b.c", "a@b.c@d.e", "x@y..z", "é.a%b+c@ü.de", "a@b-.c-d.ef.", "1.2.3.4", "1.2.3.4.5.6.7.8", "1.2.3.256", "01.002.0003.4", "1.2.3", "..1.2.3.4..", "1.2.x.3.4.5.6",
    "4111 1111 1111 1111", "4111-1111-1111-1111-", "41111111111111111111111", "4111  1111 1111 1111", "4111 1111 1111 1112 4111", "1-2", "+1 (017) 555-7713", "++49 30 1234567.", "+1 2", "+12", "+1(((", "+1 ) 2 ) 3456789 )",
    "+" + "1" * 16, "0" * 5000 + ".1.2.3", "@" * 200, "a" * 3000 + "@b.co", "1." * 500, "+1" * 300, "٣.1.2.3.4", "1.2.3.4@5.6.7.8",
]


def test_base_spans_equal_the_patterns_by_brute_force():
    rnd = random.Random(11)
    for text in EDGES:
        assert [s for s in personal_data.find(text or "") if s[0] in personal_data.BASE] == brute_base(text or ""), text
    for alphabet in ("a.@-1 +", "12 -.", "+1()-. 9", "aß@.b1"):
        for _ in range(4000):
            text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 40)))
            assert [s for s in personal_data.find(text) if s[0] in personal_data.BASE] == brute_base(text), text
    for _ in range(500):
        n = rnd.randint(12, 19)
        text = " ".join([f"x {luhn_number(rnd, n)}", "".join(rnd.choice("0123456789") for _ in range(n))])
        assert [s for s in personal_data.find(text) if s[0] in personal_data.BASE] == brute_base(text), text


def test_query_equals_brute_force_on_every_text(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    want = {}
    for r in docs.select("doc_id", "text").collect():
        spans = brute_base(r["text"] or "")
        n = Counter(s[0] for s in spans)
        want[r["doc_id"]] = (n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for k, a, b in spans))
    got = {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"], ",".join(s for s in r["spans"].split(",") if s.split(":")[0] in personal_data.BASE)) for r in queries.queries()["op11_personal_data"](spark, "/root/testdata/sf0.01").collect()}
    assert got == want
    assert sum(len(v[5]) > 0 for v in want.values()) > 10


def test_further_kinds_are_validated():
    found = lambda text: [(k, text[a:b]) for k, a, b in personal_data.find(text) if k not in personal_data.BASE]
    assert found("IBAN: DE89 3704 0044 0532 0130 00, thanks") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert found("GB82WEST12345698765432 and GB82WEST12345698765433") == [("iban", "GB82WEST12345698765432")]
    assert found("XGB82WEST12345698765432 GB82WEST1234569876543 GB82WEST123456987654321") == []
    assert found("Account no. 12345678 and account of 12345678") == [("account", "12345678")]
    assert found("accounts 12345, konto 1234 5678") == [("account", "1234 5678")]
    assert found("SSN: 123-45-6789, ssn 000-45-6789, ssn 123-45-67890") == [("ssn", "123-45-6789")]
    assert found("ftp://bob:pw@host.org/x http://10.0.0.1/ http://host.org/a@b") == [("link", "ftp://bob:pw@host.org/x"), ("link", "http://10.0.0.1/")]
    assert found("write to jo.doe [at] example [dot] org or me(at)x.org now") == [("mail", "jo.doe [at] example [dot] org"), ("mail", "me(at)x.org")]
    assert found("over the top (at) noon; the account was closed; 3://; :// x") == []


def test_personal_data_edges(spark):
    df = documents(spark, [*EDGES, "a@b.c", "a@b.c"])
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in personal_data.scan(df).collect()}
    assert got == {i: personal_data.find(t or "") for i, t in enumerate([*EDGES, "a@b.c", "a@b.c"])}
    assert personal_data.digests(personal_data.scan(df.limit(0))).count() == 0
    masked = {r["doc_id"]: r["text"] for r in personal_data.redact(df).collect()}
    assert masked[0] is None and masked[1] == "" and masked[7] == "[EMAIL]" and masked[len(EDGES)] == "[EMAIL]"
    assert personal_data.redact(df).columns == df.columns
    long = documents(spark, ["word " * 2_000_000 + "a@b.c"])
    assert [tuple(s) for s in personal_data.scan(long).collect()[0]["spans"]] == [("email", 10_000_000, 10_000_005)]


# Spelling variants


def brute_words(rows, every=97, least_length=5, least_count=3):
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def near(a, b):
    """Whether two words differ by exactly one code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(words, ratio=2):
    others = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, vs in others.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(others[w]), words.get(form[w])) for w, n in words.items()}


def as_rows(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_variants_by_brute_force(spark):
    rnd = random.Random(12)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 6))): rnd.choice([3, 3, 4, 6, 6, 12, 50]) for _ in range(500)}
    words |= {"x" * k: 2**k for k in range(1, 30)}  # a chain, and runs of one code point
    words |= {f"hub{chr(0xE0 + k)}": 5 for k in range(20)} | {"hub": 40, "hubs": 40, "hubz": 40, "😀ab": 3, "😀b": 9}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert as_rows(spelling.groups(table)) == brute_groups(words)


def test_vocabulary_by_brute_force(spark):
    rnd = random.Random(13)
    texts = [" ".join(rnd.choice(["Ähre", "Straße", "STRASSE", "ÀÉÎÕÜ×÷ÿ", "the", "Hello", "hello", "don't", "a1bcdefg", "ΑΒΓΔΕ", "abcdeĀfghij", "x" * 300]) for _ in range(rnd.randint(0, 80))) for _ in range(200)]
    rows = list(enumerate([None, "", "Hello" * 40_000, *texts])) + [(None, "Hello hello"), (3, texts[0]), (3, texts[0])]
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, word string, n long")
    assert {(r["word"], r["n"]) for r in spelling.vocabulary(df).collect()} == set(brute_words(rows).items())
    assert {(r["word"], r["n"]) for r in spelling.vocabulary(df, every=None, least_length=1, least_count=1).collect()} == set(brute_words(rows, None, 1, 1).items())
    assert as_rows(spelling.groups(spelling.vocabulary(df))) == brute_groups(brute_words(rows))
    assert spelling.groups(spelling.vocabulary(df.limit(0))).count() == 0


# Collocations


def brute_collocations(rows, least, top, percent=100):
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for m in range(1, 6):
                f.update((lang, tuple(ws[i : i + m])) for i in range(len(ws) - m + 1))
    longer = defaultdict(int)
    for (lang, p), a in f.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                longer[lang, p[i : i + size]] = max(longer[lang, p[i : i + size]], a if a >= least else 0)
    out = defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least or 100 * longer[lang, p] >= percent * a:
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, k, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for k, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)}


def phrase_rows(df):
    return {(r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


def corpus(rnd, texts):
    """Rare and frequent words, fixed phrases, repeats, all separators, two languages and none."""
    rare = [f"w{k}" for k in range(60)]
    out = []
    for _ in range(texts):
        words = []
        for _ in range(rnd.randint(0, 30)):
            words += rnd.choice([["the"], ["of"], ["The", "new", "york", "times"], [rnd.choice(rare)], [rnd.choice(rare)], ["aa"] * rnd.randint(1, 7), ["É", "É"], ["new", "york"], ["one", "two", "three", "four", "five", "six"], ["rare", "of", "kind"], [""]])
        out.append((rnd.choice(["en", "en", "de", None, "und"]), "".join(w + rnd.choice([" "] * 12 + ["\t", "  ", ". ", ",", "\n", ";", "\x0b", "\r\n", "   "]) for w in words)))
    return out


@pytest.mark.parametrize("least, top, percent", [(3, 5, 100), (3, 10_000, 100), (5, 40, 90), (2, 25, 50), (1000, 10, 100)])
def test_collocations_by_brute_force(spark, monkeypatch, least, top, percent):
    monkeypatch.setattr(phrases, "FIRST", 2)
    monkeypatch.setattr(phrases, "GROWTH", 3)
    rows = [("en", None), ("en", ""), ("en", "new york " * 5), *corpus(random.Random(14), 300)]
    df = documents(spark, [t for _, t in rows], [lang for lang, _ in rows])
    assert phrase_rows(phrases.collocations(df, least, top, percent)) == brute_collocations(rows, least, top, percent)


def test_collocations_in_small_blocks_and_with_filters_that_let_all_pass(spark, monkeypatch):
    rows = corpus(random.Random(15), 60) + [("en", "new york " * 100_000 + "the end")]
    df = documents(spark, [t for _, t in rows], [lang for lang, _ in rows])
    monkeypatch.setattr(phrases, "BLOCK", 200)
    want = brute_collocations(rows, 3, 20)
    assert phrase_rows(phrases.collocations(df, 3, 20)) == want
    real = phrases.bit_filter
    monkeypatch.setattr(phrases, "bit_filter", lambda hashes: real(hashes) | 255)
    assert phrase_rows(phrases.collocations(df, 3, 20)) == want
    assert phrases.collocations(df.limit(0)).count() == 0
    assert phrases.collocations(documents(spark, [None, ""])).count() == 0


def test_products_beyond_64_bits(spark):
    big = 10**13
    table = spark.createDataFrame([("en", "a b", big // 7)], "lang string, phrase string, n long")
    words = spark.createDataFrame([("en", "a", big // 3), ("en", "b", big // 5)], "lang string, phrase string, n long")
    totals = spark.createDataFrame([("en", big * 1000)], "lang string, n long")
    assert phrases.scored(table, words, totals).first()["score"] == 1000 * (big // 7) * (big * 1000) // ((big // 3) * (big // 5))


@pytest.mark.parametrize("name", ["op12_spelling_variants", "op13_collocations"])
def test_agrees_with_sql_on_more_rows(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    assert rows_of(queries.queries()[name](spark, sf_dir)) == rows_of_sql(database(sf_dir), queries.oracle_sql()[name])
