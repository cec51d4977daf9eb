import hashlib
import re

import pytest
from pyspark.sql import functions as F

from towerlens.llm.pii import KINDS, base_count, find_personal_data, joined_spans, luhn, mod97

from .conftest import EDGE

PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def passes(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base(text):
    out = []
    for kind, pattern in PLAIN:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(p) > 255 for p in m.group().split("."))
                    or kind == "card" and not (16 <= len(digits) <= 19 and passes(digits))
                    or kind == "phone" and not 8 <= len(digits) <= 15):
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TEXTS = ["a@b.c_x@d.ee..f@@g@h.i", "1.2.3.4.5.6.7.8 300.1.1.1 0255.1.1.1 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1111-2 5500-0000-0000-0004",
         "+1 (945) 555-5337 +12 +1234567- +123 456 78901234567 9", "\U0001F600é a.b@c.de \U0001F600 +44 20 7946 0958", "9 " * 30000, "1" * 50000,
         "a@b.cc " * 3000, "1.1.1.1 " * 2000, "+1" + " " * 20000, "5 - 4111111111111111 - 4", "", None, "0000.0000.0000.00255", "1" * 300 + ".1.1.1"]


def test_base_spans_equal_plain_patterns(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = find_personal_data(docs).select("doc_id", joined_spans(base_only=True).alias("s"), *[base_count(k).alias(k) for k in KINDS[:4]])
    for r in found.collect():
        own = base(TEXTS[r.doc_id])
        assert r.s == ",".join(own), TEXTS[r.doc_id][:60]
        assert [r[k] for k in KINDS[:4]] == [sum(s.startswith(k) for s in own) for k in KINDS[:4]]


@pytest.mark.parametrize("text,kind,expected", [
    ("IBAN DE89 3704 0044 0532 0130 00.", "iban", "DE89 3704 0044 0532 0130 00"),  # mod-97 confirms
    ("IBAN DE89 3704 0044 0532 0130 01.", "iban", None),
    ("ref GB82WEST12345698765432", "iban", "GB82WEST12345698765432"),
    ("my SSN is 123-45-6789", "ssn", "123-45-6789"),  # context words decide
    ("part number 123-45-6789", "ssn", None),
    ("ssn 000-45-6789", "ssn", None),
    ("card: 378282246310005", "card", "378282246310005"),
    ("number 378282246310005", "card", None),
    ("call 945-555-5337 now", "phone", "945-555-5337"),
    ("code 945-555-5337 now", "phone", None),
])
def test_validators_and_context(spark, text, kind, expected):
    row = find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [text[s.start:s.end] for s in row[kind]] == ([expected] if expected else [])


def test_checksums(spark):
    row = spark.createDataFrame([("4111111111111111", "4111111111111112", "GB82 WEST 1234 5698 7654 32")], "a string, b string, c string")
    assert tuple(row.select(luhn(F.col("a")), luhn(F.col("b")), mod97(F.col("c"))).first()) == (True, False, True)


def test_only_built_in_functions_and_no_shuffle(spark):
    plan = find_personal_data(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_edge_rows(edge_docs, no_docs):
    rows = find_personal_data(edge_docs).select("doc_id", joined_spans(base_only=True).alias("s")).collect()
    assert sorted(((r.doc_id or 0), r.s) for r in rows) == sorted(((d or 0), ",".join(base(t))) for d, t, *_ in EDGE)
    assert find_personal_data(no_docs).count() == 0
    empty = find_personal_data(edge_docs.where("text = ''")).select(F.sha2(joined_spans(True), 256)).first()[0]
    assert empty == hashlib.sha256(b"").hexdigest()
