import random
import re

from pyspark.sql import functions as F

from panelkit.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    def good(kind, s):
        digits = re.sub("[^0-9]", "", s)
        total = sum(d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for k, d in enumerate(map(int, reversed(digits))))
        return {"email": True, "ip": all(int(x) <= 255 for x in s.split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and total % 10 == 0, "phone": 8 <= len(digits) <= 15}[kind]

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m.group())]


def test_base_spans_equal_patterns():
    random.seed(11)
    find = pii.Finder().find
    for _ in range(30_000):
        letters = random.choice(["1234 -", "ab@.-+1", "0129.", "+12 ().-", "a1@. -+(x", "é4@+. "])
        text = "".join(random.choice(letters) for _ in range(random.randint(0, 45)))
        assert [s for s in find(text) if s[0] in pii.BASE] == brute(text), text


def test_cues_and_schemes():
    found = pii.Finder().find
    assert ("account", 6, 33) in found("IBAN: DE89 3704 0044 0532 0130 00.")
    assert ("account", 4, 15) in found("ssn 123-45-6789")
    assert not found("ssn 123-45-67890") and not found("subaccount 1234567") and not found("account of 1234567 words")
    assert ("url", 0, 26) in found("https://me:pw@host.example tail")
    assert not found("https://host.example/path") and not found("a plain sentence, nothing else. 3 of 4")


def test_common_forms_of_cues_and_numbers():
    find = pii.Finder().find
    gb, de = "GB29 NWBK 6016 1331 9268 19", "DE89 3704 0044 0532 0130 00"
    for text, number in ((f"IBAN {gb} Please pay", gb), (f"IBAN {gb} please pay", gb), (f"iban: {gb.replace(' ', '')} 12 THE END", gb.replace(" ", "")),
                         (f"The IBAN is {de} BIC COBADEFF", de), (f"IBAN {de}", de), ("IBAN NO93 8601 1117 947 Oslo", "NO93 8601 1117 947"),
                         ("account number: 12345678", "12345678"), ("account no. 12345678", "12345678"), ("Account No: 12345678", "12345678"),
                         ("ACCT NR 12345678.", "12345678"), ("acct #12345678", "12345678"), ("account number is: 12345678", "12345678"),
                         ("SSN is 123-45-6789", "123-45-6789"), ("Social Security 123-45-6789", "123-45-6789"), ("\u0130 Ssn: 123-45-6789", "123-45-6789"),
                         ("Social Security Number is 123-45-6789,", "123-45-6789"), ("sOcIaL sEcUrItY No.: 123-45-6789", "123-45-6789")):
        at = text.index(number)
        assert [s for s in find(text) if s[0] == "account"] == [("account", at, at + len(number))], text
    for text in (f"IBAN {gb[:-1]}8 Please", f"IBAN {gb}Please", "account number of 12345678", "account number 12345", "account numbers 12345678", "SSN is 123-45-67890",
                 "account is is is is 12345678", "subaccount no. 12345678", "account no", "account ", "IBAN is"):
        assert not [s for s in find(text) if s[0] == "account"], text


def test_column_redaction_and_edge_rows(texts_frame):
    long_text = "é " * 50_000 + "a@b.cd " + "x" * 50_000
    rows = [(1, "write a@b.cd or 10.0.0.1, a@b.cd"), (2, None), (3, ""), (1, "write a@b.cd or 10.0.0.1, a@b.cd"), (None, long_text)]
    out = texts_frame(rows).select("*", pii.pii_spans("text").alias("spans"))
    out = out.select("*", pii.redact(F.col("text"), F.col("spans")).alias("clean")).collect()
    for r in out:
        assert [(s.kind, s.start, s.end) for s in r.spans if s.kind in pii.BASE] == brute(r.text)
    assert sorted(r.clean for r in out if r.doc_id == 1) == ["write <email> or <ip>, <email>"] * 2
    assert [r.clean for r in out if r.doc_id == 2] == [None]
    assert texts_frame([]).select(pii.pii_spans("text")).count() == 0
