import random
import re

from fareflow.llm import pii as P

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        t += x - 9 if x > 9 else x
    return t % 10 == 0


def brute(text):
    out = []
    for rank, (k, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": k == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                  "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[k]
            if ok:
                out.append((m.start(), rank, f"{k}:{m.start()}:{m.end()}"))
    return ",".join(x for *_, x in sorted(out))


def run(spark, texts):
    df = spark.createDataFrame([(i, t, 3, "k") for i, t in enumerate(texts)],
                               "doc_id long, text string, row_key int, kind string")
    from pyspark.sql import functions as F
    rows = P.find(df).select("doc_id", P.joined(F.filter("found", lambda s: s["base"])).alias("b"),
                             P.joined(F.col("found")).alias("a")).collect()
    assert len(rows) == len(texts)
    return {r.doc_id: r for r in rows}


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(5)
    texts = [None, "", "a@b.c.d@e.f", "a@b.c_d@e.f x@y.z", "1.2.3.4.5.6.7.8 300.1.1.1 1.2.3",
             "0000255.1.1.1 256.1.1.1 99999999999999999999.1.1.1", "é 4111 1111 1111 1111 é",
             "4111-1111-1111-1111 4111 1111 1111 1112", "12345678901234567890123 1  2",
             "+1 (988) 555-2485. +49--30 12345678 +12", "call +1 4111 1111 1111 1111",
             "1" * 4000, "a" * 4000 + "@", ("1.2.3.4 " * 300), "😀 +1 234 567 8901 😀 u@v.w",
             "4222222222222 42222222222220 4222 2222 2222 20-", "a@b.c@d.e"]
    alphabet = "0123456789  .-+()@aB_%é\n"
    for _ in range(400):
        texts.append("".join(rng.choice(alphabet) for _ in range(rng.randrange(120))))
    for _ in range(200):
        texts.append("".join(rng.choice("0011  -.+@ab.") for _ in range(60)))
    got = run(spark, texts)
    for i, t in enumerate(texts):
        assert got[i].b == brute(t), t


def test_added_kinds_need_checksum_or_context(spark):
    got = run(spark, ["IBAN DE89 3704 0044 0532 0130 00 ok", "x DE88 3704 0044 0532 0130 00",
                      "my ssn is 078-05-1120", "part 078-05-1120", "call 555-123-4567 now",
                      "order 555-123-4567"])
    assert [got[i].a for i in range(6)] == ["iban:5:32", "", "ssn:10:21", "", "tel:5:17", ""]


def test_redaction(spark):
    rows = [(1, "mail a@b.cc or pay 4111 1111 1111 1111!", "en", "s", 5), (2, None, "en", "s", 0),
            (3, "clean", "en", "s", 5), (3, "clean", "en", "s", 5),
            (4, "x 4111111111111111 y 10.0.0.1", "en", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = P.redact(df)
    assert out.columns == df.columns
    got = sorted((r.doc_id, r.text, r.n_chars) for r in out.collect() if r.text is not None)
    assert got == [(1, "mail [EMAIL] or pay [CARD]!", 27), (3, "clean", 5), (3, "clean", 5),
                   (4, "x [CARD] y [IP]", 15)]
    assert out.count() == 5
    assert P.redact(df.limit(0)).count() == 0
