import random
import re

from pyspark.sql import functions as F

from panelkit.llm import pii, secrets

BASE = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 12),
        ("access", "AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 18), ("hex", "[0-9a-f]+", lambda m: len(m.group()) >= 16)]


def brute(text):
    found = [(m.start(), place, kind, m.end()) for place, (kind, p, good) in enumerate(BASE) for m in re.finditer(p, text or "") if good(m)]
    return [(s, k, e) for s, _, k, e in sorted(found)]


def made(n=400):
    random.seed(6)
    bits = ["token", "Password", "API_KEY", "apikey", "secret", "passwd", ":", "=", " ", "\"", "'", "AKIA", "ABCDEF", "0123", "deadbeef", "é", "\n", "x", "-", "/", "ZZ9"]
    return [(i, "".join(random.choice(bits) for _ in range(random.randint(0, 30)))) for i in range(n)]


def _scan(versions, ledger=None, rules=secrets.RULES):
    findings, added = secrets.scan_versions(versions, ledger=ledger, rules=rules)
    return findings, added


def test_findings_equal_patterns(texts_frame):
    rows = made(700) + [(1, None), (2, ""), (None, "token=" + "a1" * 20), (3, "token: secret:abcdefghijklmno"), (4, "AKIA" * 12), (5, "f" * 70_000 + " é api_key='" + "Q" * 50_000)]
    rows += rows[:50]
    frame = texts_frame(rows)
    findings, _ = _scan(frame)
    out = secrets.join_back(frame, findings).collect()
    assert len(out) == len(rows)
    kinds = {k for k, *_ in BASE}
    for r in out:
        assert [(s.start, s.kind, s.end) for s in r.secret_spans if s.kind in kinds] == brute(r.text), r.text
        assert [s.start for s in r.secret_spans] == sorted(s.start for s in r.secret_spans)
    assert sum(len(r.secret_spans) for r in out) > 100


def test_added_rules_and_redaction(texts_frame):
    text = "see ghp_" + "A1b2" * 9 + " and\n-----BEGIN RSA PRIVATE KEY-----\npassword = hunter2hunter2!"
    frame = texts_frame([(1, text), (2, "clean text, a token of thanks")])
    out = secrets.join_back(frame, _scan(frame)[0])
    out = {r.doc_id: r for r in out.select("*", pii.redact(F.col("text"), F.col("secret_spans")).alias("clean")).collect()}
    assert [s.kind for s in out[1].secret_spans] == ["github", "private_key", "assign"]
    assert out[1].clean == "see <github> and\n<private_key>\n<assign>!"
    assert out[2].clean == out[2].text and not out[2].secret_spans


def test_no_line_of_a_private_key_survives(spark):
    import corpus_pipeline

    body = [("Q9b/" * 16)[k:] + "A+z4"[:k] for k in range(4)] + ["mRk7Lw=="]
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    whole = "\n".join([begin, *body, end])
    crypt = "\n".join([begin, "Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0A1B", "", *body])
    texts = [f"a {whole} b", f"a {whole} b {whole} c", f"a {whole.replace(chr(10), chr(13) + chr(10))} b", f'a "{whole.replace(chr(10), chr(92) + "n")}" b',
             f"a {crypt}\n{end} b", f"a {crypt}\nplain words follow", "\n".join(["a " + begin, *body, "plain words follow"]), "\n".join(["a " + begin, *body]),
             " ".join(["a", begin, body[0], "plain"]), f"token=abcd{whole} b", "\n".join(["a " + begin, *body, whole, "b"]),
             "a " + begin + "\n" + "\n".join(["Ab1/" * 16] * 20_000) + "\n" + end + " b", "a " + "- x " * 50_000 + begin + " - y" * 50_000]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    after = {r.doc_id: r.text for r in corpus_pipeline.hide_secrets(spark, docs, "").collect()}
    for t in after.values():
        assert not any(line in t for line in [*body, "Ab1/" * 16, "PRIVATE KEY", "DEK-Info"])
    key = "<private_key>"
    assert [after[k] for k in range(9)] == [f"a {key} b", f"a {key} b {key} c", f"a {key} b", f'a "{key}" b', f"a {key} b", f"a {key}\nplain words follow",
                                            f"a {key}\nplain words follow", f"a {key}", f"a {key} plain"]
    assert after[9] == "<assign> b" and after[10] == f"a {key}\n{key}\nb" and after[11] == f"a {key} b"
    assert after[12] == texts[12].replace(begin, key)


def test_ledger_leaves_only_unseen_pairs(texts_frame):
    rows = made(60)
    frame = texts_frame(rows)
    first, ledger = _scan(frame)
    ledger = ledger.cache()
    blobs = len({t for _, t in rows})
    assert ledger.count() == blobs * len(secrets.RULES)
    again, added = _scan(frame, ledger)
    assert again.count() == 0 and added.count() == 0
    more = texts_frame(rows + [(100, "password=abcdefghijklmnop"), (101, "password=abcdefghijklmnop")])
    found, added = _scan(more, ledger)
    assert added.count() == len(secrets.RULES) and [r.kind for r in found.collect()] == ["assign"]
    newer = (secrets.Rule("hex", "[0-9a-f]{12,}", version=2), *secrets.BASE_RULES[:2])
    found, added = _scan(frame, ledger, newer)
    assert added.count() == blobs and {r.kind for r in found.collect()} == {"hex"}
    assert {(r.kind, r.version) for r in added.collect()} == {("hex", 2)}


def test_equal_blobs_are_scanned_once(texts_frame):
    frame = texts_frame([(i, "token=abcdefghijklmnop") for i in range(30)])
    findings, _ = _scan(frame)
    assert findings.count() == 1
    assert all(len(r.secret_spans) == 1 for r in secrets.join_back(frame, findings).collect())


def test_empty_table(texts_frame):
    frame = texts_frame([])
    findings, added = _scan(frame)
    assert added.count() == 0 and secrets.join_back(frame, findings).count() == 0


def test_a_kept_ledger_shows_old_secrets_and_replaces_those_of_old_rules(texts_frame, tmp_path):
    folder = str(tmp_path / "ledger")
    one, two = "key AKIA" + "A" * 16, "token = 'abcdefghijklmnop'"
    first = texts_frame([(1, one), (2, "nothing"), (3, None)])
    assert secrets.scan_with_ledger(first, folder).count() == 1
    later = texts_frame([(1, one), (4, one), (5, two), (6, None)])
    found = secrets.scan_with_ledger(later, folder)
    spans = {r.doc_id: [s.kind for s in r.secret_spans] for r in secrets.join_back(later, found, keep=["doc_id"]).collect()}
    assert spans == {1: ["access"], 4: ["access"], 5: ["assign"], 6: []}
    spark = first.sparkSession
    scanned = spark.read.parquet(folder + "/scanned")
    assert scanned.count() == scanned.distinct().count() == 4 * len(secrets.RULES)  # four blobs, each once per rule
    assert secrets.scan_with_ledger(later, folder).count() == 2 and spark.read.parquet(folder + "/scanned").count() == scanned.count()
    raised = tuple(secrets.Rule("access", "AKIA[B-Z]{14,}", version=2) if r.kind == "access" else r for r in secrets.RULES)
    assert [r.kind for r in secrets.scan_with_ledger(later, folder, rules=raised).collect()] == ["assign"]
    assert spark.read.parquet(folder + "/scanned").count() == 4 * len(secrets.RULES) + 3
    # A scan that broke off after it had stored its findings is done again; they count once.
    spark.read.parquet(folder + "/found").write.mode("append").parquet(folder + "/found")
    assert secrets.scan_with_ledger(later, folder).count() == 2
