import hashlib
import random
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from barloom.llm.decontaminate import clean_documents, contaminated_words  # noqa: E402
from barloom.llm.pii import BASE, KINDS, find_spans, luhn, mod97, redact, with_spans  # noqa: E402
from barloom.llm.queries import op2_pii  # noqa: E402
from plain import SF, documents, hit_words, letter_words, table  # noqa: E402

WORDS = "ka lo mi ne po ru sa te vu wo".split()


def passage(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_every_shared_passage_is_found(spark):
    rng = random.Random(5)
    long = [passage(rng, 40) for _ in range(4)]
    items = [(i, t) for i, t in enumerate(long)] + [(10, "Lonely"), (11, "three short words"), (12, " ".join(f"w{i}" for i in range(9))), (13, None), (14, "--"), (0, long[1]), (None, "nameless one")]
    texts = [None, "", "...", "lonely", "a LONELY b lonely", "three short", "x three, short; words y", " ".join(f"W{i}" for i in range(9)), "nameless one"]
    for _ in range(40):
        own = letter_words(rng.choice(long))
        at, n = rng.randrange(30), rng.choice([8, 9, 10, 11, 25])
        texts.append(f"{passage(rng, rng.randrange(9))} {' , '.join(own[at : at + n])} {passage(rng, rng.randrange(9))} {' '.join(own[:rng.randrange(14)])}")
    texts += [texts[-1], texts[-1]]
    ids = [*range(len(texts) - 2), None, 3]
    docs = documents(spark, texts, ids, extra="n_words spans row item_id")
    found = contaminated_words(docs, table(spark, [(i, t, "x") for i, t in items], "item_id long, text string, doc_id string"))
    rows = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()]
    want = []
    for i, t in zip(ids, texts, strict=True):
        places, names = hit_words(t, items)
        want.append((i, len(letter_words(t)), len(places), sorted(names - {"None"})))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(rows, key=key) == sorted(want, key=key)
    hit = [w[2] > 0 for w in want]
    kept = clean_documents(docs, table(spark, items, "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(map(str, (r["text"] for r in kept.collect()))) == sorted(str(t) for t, h in zip(texts, hit, strict=True) if not h)


def test_nothing_to_hold_against(spark):
    docs = documents(spark, ["one two", None])
    none = table(spark, [], "item_id long, text string")
    assert [r["n_hit"] for r in contaminated_words(docs, none).collect()] == [0, 0]
    assert clean_documents(docs, none).count() == 2
    assert contaminated_words(docs.limit(0), table(spark, [(1, "one two")], "item_id long, text string")).count() == 0


def plain_base(text):
    """The four kinds by their plain expressions."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+".replace(r"\x20-", r"\x20\-"), lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text or "") if ok(m[0])]


SAMPLES = [
    None, "", "a@b", "a@b.c", "x a.b+c@d-e.f.gh. y", "@b.c", "a@b.c@d.e", "é€ me@x.org 𝄞 you@y.org", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.04",
    "1.2.3.", "4111 1111 1111 1111", "4111-1111-1111-1111 and 4111111111111112", "4111  1111 1111 1111", "+1 (555) 555-0123", "+12345678", "+1 2 3 4 5 6 7 8 9 ", "+(1)23456789",
    "++49 30 1234567", "card 5500005555555559 cvv", "9" * 5000, "1." * 300, "+1" + " " * 200 + "2", "a" * 3000 + "@", "@" * 50,
]


def test_base_spans_against_the_plain_expressions():
    rng = random.Random(2)
    texts = SAMPLES + ["".join(rng.choice("0123456789 .-+()@aZ%_é") for _ in range(rng.randrange(120))) for _ in range(4000)]
    texts += ["".join(rng.choice(["4111111111111111", "1.2.3.4", "a@b.c", "+1 555 555 0199", " ", "-", ".", "7"]) for _ in range(8)) for _ in range(1500)]
    for t in texts:
        assert [(s.kind, s.begin, s.end) for s in find_spans(t) if s.kind in BASE] == plain_base(t), t


def test_checksums_and_context():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert mod97("GB82WEST12345698765432") and not mod97("GB82WEST12345698765433")
    assert [s.kind for s in find_spans("IBAN GB82 WEST 1234 5698 7654 32.")] == ["iban"]
    assert find_spans("GB82 WEST 1234 5698 7654 33") == []
    assert [s.kind for s in find_spans("social security 123-45-6789")] == ["ssn"] and find_spans("part 123-45-6789") == []
    near, far = find_spans("call +1 555 555 0123")[0], find_spans("so +1 555 555 0123")[0]
    assert near.score > far.score > find_spans("order +1 555 555 0123")[0].score


def test_iban_before_other_words():
    codes = ["DE89370400440532013000", "GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 32", "NO9386011117947", "MT84MALT011000012345MTLCAST001S"]
    followers = [" BIC COBADEFFXXX", " OR", " 2024", " A B C D", " BICode", " 1", ", BIC X", ".", "", " and", "\nBIC", " GB82WEST12345698765433"]
    for code in codes:
        for follower in followers:
            for before in ("", "to ", "FROM AB12 ", "IBAN XY00 1234 1234 1234 "):
                spans = [s for s in find_spans(before + code + follower) if s.kind not in BASE]
                assert [(s.kind, s.begin, s.end) for s in spans] == [("iban", len(before), len(before) + len(code))], (before, code, follower)
    both = f"{codes[0]} {codes[2]} BIC {codes[1]} 2024 {codes[3]}"
    assert redact(both, find_spans(both)) == "[IBAN] [IBAN] BIC [IBAN] 2024 [IBAN]"
    assert find_spans("GB82WEST12345698765433 OR") == find_spans("xGB82WEST12345698765432 OR") == find_spans(codes[1] + "x") == []
    assert [s.end for s in find_spans("DE89370400440532013000 99")] == [22]


def test_iban_in_the_pipeline_stage(spark):
    import corpus_pipeline

    docs = documents(spark, ["Pay DE89370400440532013000 BIC COBADEFFXXX", "GB82 WEST 1234 5698 7654 32 2024"])
    rows = corpus_pipeline.pii(spark, docs, SF).collect()
    assert [(r["text"], r["n_chars"]) for r in rows] == [("Pay [IBAN] BIC COBADEFFXXX", 26), ("[IBAN] 2024", 11)]


def test_redaction(spark):
    text = "Mail me@x.org, 4111 1111 1111 1111 or +1 555 555 0199 é"
    assert redact(text, find_spans(text)) == "Mail [EMAIL], [CARD] or [PHONE] é"
    docs = documents(spark, [text, None, ""], [1, None, 1], extra="pii_spans kind")
    rows = with_spans(docs, redacted="text").collect()
    assert [r["text"] for r in rows] == ["Mail [EMAIL], [CARD] or [PHONE] é", None, ""] and rows[0]["kind"] == "x"
    assert [len(r["pii_spans"]) for r in rows] == [3, 0, 0] and with_spans(docs.limit(0)).count() == 0


def test_query_digest(spark):
    rows = {r["doc_id"]: r for r in op2_pii(spark, SF).collect()}
    source = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(source)
    for r in source:
        base, got = plain_base(r["text"]), rows[r["doc_id"]]
        assert got["base_sha256"] == hashlib.sha256(",".join(f"{k}:{b}:{e}" for k, b, e in base).encode()).hexdigest()
        assert [got[f"n_{k}"] for k in BASE] == [sum(b[0] == k for b in base) for k in BASE]
        listed = [s.split(":") for s in got["spans"].split(",") if s]
        assert listed == sorted(listed, key=lambda s: (KINDS.index(s[0]), int(s[1])))


def test_random_codes_are_no_ibans():
    """Product keys in blocks: none of a country that is not listed, one in 97 at most of those of the right length."""
    rng = random.Random(8)
    for country, bound in (("XQ", 0), ("DE", 300)):
        found = 0
        for _ in range(20_000):
            code = country + f"{rng.randint(0, 99):02}" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(4 * rng.randint(3, 7)))
            found += any(s.kind == "iban" for s in find_spans(" ".join(code[i : i + 4] for i in range(0, len(code), 4))))
        assert found <= bound
