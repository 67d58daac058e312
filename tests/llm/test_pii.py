import hashlib
import re

from custvalue.llm import pii as P

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def slow(text):
    out = []
    for no, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                  "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]()
            if ok:
                out.append((m.start(), no, m.end(), kind))
    return sorted(out)


def check(rows, texts):
    texts = dict(texts)
    for r in rows:
        spans = slow(texts[r.doc_id])
        base = [f"{k}:{a}:{b}" for a, _, b, k in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), (r, base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[3] == k for s in spans) for k in P.KINDS)
        every = [s for s in r.spans.split(",") if s]
        assert set(base) <= set(every) and len(every) == len(base) + r.n_added
        keys = [(int(s.split(":")[1]), P.KINDS.index(s.split(":")[0])) for s in every]
        assert keys == sorted(keys)


def test_matches_base_patterns(spark, documents):
    check(P.personal_data(documents).collect(), [(r.doc_id, r.text) for r in documents.collect()])


def test_hard_texts(spark, empty, odd):
    texts = ["a@b.c@d.e", "a@b.c..d@e.f x", "a@b.c_x@d.e", "@a.b", "a.b@c", "é@b.co, ü x@y-z.co.uk.", "1.2.3.4.5.6.7.8", "999.1.1.1 0.0.0.0 001.2.3.4 1.2.3",
             "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "4111  1111 1111 1111", "+1 (555) 555-1234 4111111111111111", "+49 30 1234567890)", "+1", "++12 345 678 9012",
             "日本 1.2.3.4 naïve+tag@例.com a@b.com", "x" * 50_000 + "@" + "y." * 3000 + "z", "1 " * 30_000, "1" * 60_000, "+1" + " 2" * 20_000, "tel +1 (202) 555-0101 37.92.178.161", "joe (at) host (dot) com", "12345678901234567890", "10.0.0.1,10.0.0.2;10.0.0.256"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = P.personal_data(frame).collect()
    assert len(got) == len(texts)
    check(got, enumerate(texts))
    assert P.personal_data(empty).count() == 0
    rows = P.personal_data(odd).collect()
    assert len(rows) == 12 and all(r.spans == "" for r in rows)


def test_no_python_on_the_executors(documents):
    plan = P.personal_data(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_reliabilities_find_the_good_labellers():
    counts = [("card", "0++0+", 400), ("card", "0--0-", 400), ("card", "0+-0+", 40), ("card", "0-+0-", 40)]
    p = P.reliabilities(counts)
    assert p["card", "0++0+"] > 0.95 and p["card", "0--0-"] < 0.05 and p["card", "0+-0+"] > 0.8
    c = P.span_classifier([(k, v, "00nee", n) for k, v, n in counts], p)
    assert c["card", "0++0+", "00nee"] > 0.9 > 0.5 > c["card", "0--0-", "00nee"]


def test_run_on_phone_is_added(spark):
    rows = [(i, f"call +1 (202) 555-0{100 + i} now") for i in range(200)] + [(999, "call +1 (202) 555-0101 4111111111111111 now")]
    got = {r.doc_id: r for r in P.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[999].n_phone == 0 and got[999].n_added == 2 and got[999].spans == "phone:5:22,card:23:39"
    assert all(got[i].n_phone == 1 and got[i].n_added == 0 for i in range(200))


def test_numbers_run_together_are_taken_apart(spark):
    usual = ["call +1 (202) 555-0101 now", "visa 4111 1111 1111 1111 paid", "from 10.0.0.12 again", "mail a.b@host.com now", "paid 5500000000000004 today"]
    rows = [(i, usual[i % 5]) for i in range(500)]
    texts = {901: "card 4111 1111 1111 1111 123", 902: "+1 202 555 0101 4111111111111111", 903: "mail joe (at) host (dot) com or 10[.]0[.]0[.]12",
             904: "ref 1234 4111 1111 1111 1111", 905: "card 4111 1111 1111 1112 123", 906: "section 999.1.1.1.1", 907: "no data"}
    got = {r.doc_id: r for r in P.personal_data(spark.createDataFrame(rows + list(texts.items()), "doc_id bigint, text string")).collect()}
    assert {d: got[d].spans for d in texts} == {
        901: "card:5:24", 902: "phone:0:15,card:16:32", 903: "email:5:28,ip:32:47", 904: "card:9:28", 905: "", 906: "", 907: ""}
    assert all(r.n_added == 0 for d, r in got.items() if d < 900)


def test_added_spans_on_labelled_texts(spark):
    """Precision and recall of all spans on texts whose true spans are known, against the base patterns alone."""
    import random
    rng = random.Random(7)

    def card():
        d = [4, *(rng.randrange(10) for _ in range(14))]
        return "".join(map(str, d)) + next(c for c in "0123456789" if luhn("".join(map(str, d)) + c))

    def four(d):
        return " ".join(d[i:i + 4] for i in range(0, 16, 4))

    make = {
        "card": lambda: rng.choice([lambda d: d, four])(card()),
        "phone": lambda: rng.choice(["+1 (%03d) %03d-%04d", "+1 %03d %03d %04d"]) % (rng.randrange(201, 999), rng.randrange(200, 999), rng.randrange(9999)),
        "ip": lambda: ".".join(str(rng.randrange(1, 223)) for _ in range(4)),
        "email": lambda: "n%d@host%d.%s" % (rng.randrange(99), rng.randrange(99), rng.choice(["com", "org", "de"]))}
    noise = ["the end", "order 123 456", "page 12.4", "version 3.1.2", "in 1999", "at 10 to 12"]
    docs, truth = [], set()
    for i in range(1500):
        text = ""
        for _ in range(rng.randrange(1, 4)):
            if rng.random() < 0.6:
                kind = rng.choice(sorted(make))
                span = make[kind]()
                truth.add((i, f"{kind}:{len(text)}:{len(text) + len(span)}"))
                text += span
            else:
                text += rng.choice(noise)
            text += rng.choice([" ", " and ", "; "])
        docs.append((i, text))
    out = {r.doc_id: r.spans for r in P.personal_data(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    found = {(i, s) for i, spans in out.items() for s in spans.split(",") if s}
    base = {(i, f"{k}:{a}:{b}") for i, t in docs for a, _, b, k in slow(t)}
    rate = lambda got: (len(got & truth) / len(got), len(got & truth) / len(truth))
    print("base precision, recall", rate(base), "all", rate(found), "added", rate(found - base))
    assert base <= found
    assert rate(found)[1] > rate(base)[1] + 0.02 and rate(found)[0] > 0.99 and rate(found - base)[0] > 0.95
