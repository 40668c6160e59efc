"""Personal data: base spans against plain Python, learned ones on planted text."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from freshet.llm import op12_pii as op

SCHEMA = "doc_id long, text string, spans string, codes int, n long"


def _luhn(d):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def _plain(text):
    """The base spans by the patterns as the contract gives them."""
    text = text or ""
    number = lambda m: re.sub("[^0-9]", "", m)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(number(m)) <= 19 and _luhn(number(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(number(m)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m[0])]


def _docs(spark, tmp_path, texts):
    folder = str(tmp_path / "sf")
    rows = [(i, t, "clash", 1, 2) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def _card(rng, ok):
    while True:
        d = "4" + "".join(rng.choices("0123456789", k=15))
        if _luhn(d) == ok:
            return d


def _texts():
    rng = random.Random(12)
    parts = ["a.b@c.d", "x@y", "x@y.z_q@r.s", "é@ü.de", "m+1@a-b.co.uk.", "@", "1.2.3.4", "1.2.3.4.5", "256.1.1.1", "001.02.3.0004", "12.3.4", "9" * 30 + ".1.1.1",
             "4111 1111 1111 1111", "4111-1111-1111-1111", "4111  1111", _card(rng, True), _card(rng, False), _card(rng, True) + " " + _card(rng, True), "1-2-3",
             "+1 (555) 555-0199", "+49", "+1234567", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", "+(555)", "+1 (555) 555-0199 10.0.0.1", "++33 1.22.33.44.55", "🙂", "\n", "\t", " ", "Ä", ".", "abc"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(250)]
    texts += [" ".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(250)]
    texts += ["".join(rng.choices("01.@+- (a", k=rng.randrange(60))) for _ in range(250)]
    long_ = ["1" * 60_000, "a" * 60_000 + "@", "1 " * 40_000, "+" + "1" * 40_000 + "(", "a." * 30_000 + "@b" + ".c" * 30_000, "é" * 50_000 + "a@b.c", "1.2.3.4 " * 300]
    return [*texts, *long_, None, "", texts[0], texts[0]]


def test_base_spans_like_plain_python(spark, tmp_path):
    texts = _texts()
    out = op.op12_pii(spark, _docs(spark, tmp_path, texts))
    assert out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().optimizedPlan().toString())
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        want, got = _plain(text), rows[i]
        named = [f"{k}:{a}:{b}" for k, a, b in want]
        assert got["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest(), (text or "")[:200]
        assert [got[f"n_{k}"] for k in op.BASE] == [sum(w[0] == k for w in want) for k in op.BASE]
        found = got["spans"].split(",") if got["spans"] else []
        assert not {*named} - {*found}
        order = [(op.KINDS.index(k), int(a), int(b)) for k, a, b in (x.split(":") for x in found)]
        assert order == sorted(order)


def _planted(rng):
    """(text, hidden spans' texts); fillers hold numbers that are no personal data."""
    word = lambda: rng.choice(["lorem", "ipsum", "dolor", "sit", "amet"])
    texts = []
    for i in range(300):
        base = rng.choice([f"mail {word()}{i}@host.com", f"call +1 (555) 555-{i:04d}", f"from 81.{i % 250}.7.9", f"card {_card(rng, True)}"])
        texts.append((f"{word()} {word()} {base} {word()}.", []))
        clean = rng.choice([f"order {_card(rng, False)}", f"version 3.{i}.300.1", f"part 7{_card(rng, False)}{i}", f"{word()} {i} {word()}", _card(rng, False)])
        texts.append((f"{word()} {clean} {word()}", []))
    for i in range(20):
        phone, pair = f"+1 (555) 555-{i:04d}", (_card(rng, True), _card(rng, True))
        texts.append((f"{word()} {phone} 10.0.0.{i} {word()}", [phone]))
        texts.append((f"{word()} {pair[0]} {pair[1]} {word()}", [*pair]))
        obscured = f"ann{i} [at] host [dot] com"
        texts.append((f"contact {obscured} {word()}", [obscured]))
        texts.append((f"iban DE89 3704 0044 0532 0130 00 {word()}", ["DE89 3704 0044 0532 0130 00"]))
        texts.append((f"name: Mrs Anna Smith, {word()}", ["Mrs Anna Smith"]))
    return texts


def test_learned_spans_on_planted_text(spark):
    planted = _planted(random.Random(3))
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(planted)], "doc_id long, text string")
    got = {r["doc_id"]: {planted[r["doc_id"]][0][s["start"]:s["end"]] for s in r["spans"] if not s["base"]} for r in op.find_personal_data(docs).collect()}
    for i, (text, hidden) in enumerate(planted):
        assert got[i] == set(hidden), text


def test_reliabilities_of_a_known_mixture(spark):
    """Votes drawn with known rates; the estimate comes near them."""
    rng, rows = random.Random(4), []
    rate = {"form": (0.9, 0.2), "shape": (0.8, 0.4), "gazetteer": (0.7, 0.1), "apart": (0.95, 0.5)}
    for _ in range(6000):
        kind, truth = rng.choice([0, 1]), rng.random() < 0.4
        votes = [2 * j + (rng.random() < rate[name][not truth]) for j, name in enumerate(op.LABELERS) if name in rate and rng.random() < 0.9]
        rows.append(([*votes, op._KIND + kind],))
    seen = spark.createDataFrame(rows, "codes array<int>").groupBy("codes").agg(F.count("*").alias("n")).coalesce(1)
    weights, found = op.estimate(seen, rounds=60)
    for name, want in rate.items():
        assert all(abs(a - b) < 0.08 for a, b in zip(found[name], want)), (name, found[name])
    # The classifier agrees with the estimate wherever that is sure.
    fitted = op.fit(seen, weights)
    for r in seen.collect():
        p, q = (1 / (1 + 2.718281828 ** -sum(w[c] for c in r["codes"])) for w in (weights, fitted))
        assert not (p > 0.9 and q < 0.5 or p < 0.1 and q > 0.5)


def test_nothing_proposed_and_empty_table(spark, tmp_path):
    rows = op.op12_pii(spark, _docs(spark, tmp_path, [None, "", "plain words"])).collect()
    none = hashlib.sha256(b"").hexdigest()
    assert sorted(tuple(r) for r in rows) == [(i, 0, 0, 0, 0, none, "") for i in range(3)]
    assert op.op12_pii(spark, _docs(spark, tmp_path / "none", [])).collect() == []


def test_checksums(spark):
    df = spark.createDataFrame([("4111111111111111", "DE89370400440532013000"), ("4111111111111112", "DE88370400440532013000"), ("0", "GB82 WEST 1234 5698 7654 32")], "a string, b string")
    assert [tuple(r) for r in df.select(op.luhn(F.col("a")), op.mod97(F.col("b"))).collect()] == [(True, True), (False, False), (True, True)]
