"""Personal data: base spans against the plain patterns, added spans, robustness."""

import hashlib
import random
import re

from llm_fixtures import clashing, docs_of  # noqa: F401  (fixtures)
from tessera.llm import pii as PI

KINDS = ["email", "ip", "card", "phone"]


def brute(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group(0).split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group(0) if c.isdigit()][::-1]
        total = sum(c if i % 2 == 0 else sum(divmod(2 * c, 10)) for i, c in enumerate(d))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(re.sub("[^0-9]", "", m.group(0))) <= 15]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def test_base_spans_equal_the_patterns():
    r = random.Random(5)
    for alphabet in ("ab@@..--_%+ 0123456789()é", "12345. -+", "aB@.-_ "):
        for _ in range(8000):
            text = "".join(r.choice(alphabet) for _ in range(r.randrange(70)))
            assert [x[:3] for x in PI.find_spans(text) if x[4]] == brute(text), text


def test_added_spans_need_a_checksum_or_context():
    def added(text):
        return [(k, text[s:e]) for k, s, e, _, base in PI.find_spans(text) if not base]

    assert added("4465758382889437 4465758382889437") == [("card", "4465758382889437")] * 2 or not PI.luhn("4465758382889437")
    assert added("paid 12 4111 1111 1111 1111 99") == [("card", "4111 1111 1111 1111")]
    assert added("to DE89 3704 0044 0532 0130 00, GB82WEST12345698765432") == [
        ("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432")]
    assert added("DE89 3704 0044 0532 0130 01") == []  # mod-97 fails
    assert added("my SSN is 123-45-6789") == [("ssn", "123-45-6789")]
    assert added("part 123-45-6789") == [] and added("123-45-6789") == []
    assert added("call 555-123-4567") == [("phone", "555-123-4567")] and added("row 555-123-4567") == []
    with_word, without = (PI.find_spans(t)[0][3] for t in ("mail me: a@b.io", "xx: a@b.io"))
    assert with_word > without
    low, high = (PI.find_spans(t)[0][3] for t in ("version 1.2.3.4", "host 1.2.3.4"))
    assert low < PI.THRESHOLD <= high and PI.find_spans("version 1.2.3.4")[0][4]  # base spans stay


def test_long_runs_are_scanned_once():
    import time
    for unit in ("a", "1", "1.", "@", "a@", "+1 ", "1 ", "4111 ", "DE12"):
        start = time.monotonic()
        PI.find_spans(unit * (400_000 // len(unit)))
        assert time.monotonic() - start < 20, unit


def test_find_personal_data(spark, docs_of, clashing):  # noqa: F811
    rows = [(1, "é a.b@c.de and 10.0.0.1"), (2, None), (3, ""), (None, "+1 (743) 555-3824"), (1, "é a.b@c.de and 10.0.0.1"),
            (4, "x" * 20_000 + " 1.2.3.4"), (5, "clean text, 300.1.1.1")]
    found = PI.find_personal_data(clashing(docs_of(rows)), mask=True)
    got = sorted(((r.doc_id, r.masked[-30:], [x.kind for x in r.spans]) for r in found.collect()), key=repr)
    want = sorted([(1, "é <email> and <ip>", ["email", "ip"])] * 2 + [
        (2, "", []), (3, "", []), (None, "<phone>", ["phone"]), (4, ("x" * 300 + " <ip>")[-30:], ["ip"]),
        (5, "clean text, 300.1.1.1"[-30:], [])], key=repr)
    assert got == want
    digest = sorted((tuple(r) for r in PI.digest(found).collect()), key=repr)
    for i, text in rows:
        base = brute(text or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert (i, *[sum(k == b[0] for b in base) for k in KINDS],
                hashlib.sha256(joined.encode()).hexdigest(), joined) in digest
    assert len(digest) == len(rows)
    assert PI.find_personal_data(docs_of([])).count() == 0


def test_query_equals_brute_force(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in E.queries()["op11_pii"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        base = brute(d.text or "")
        r = got[d.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == b[0] for b in base) for k in KINDS)
        joined = [f"{k}:{s}:{e}" for k, s, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(r.spans.split(",")) if joined else True
