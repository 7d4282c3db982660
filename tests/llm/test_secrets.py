import hashlib
import random
import re

from helpers import AWKWARD, documents, empty

from rollbook.llm import queries, secrets as sec


def base(text):
    """The contract's patterns, word for word."""
    text = text or ""
    keyword = "(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key")) + ")"
    found = [("assign", *m.span()) for m in re.finditer(keyword + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_base_spans_equal_the_patterns():
    dice = random.Random(3)
    parts = ["password", "PassWd", "token", "Secret", "API_KEY", "apikey", "=", ":", " ", '"', "'", "abc", "abcdef0123", "AKIA", "AKIAAKIA" + "Z9" * 9,
             "0123456789abcdef" * 2, "é", "ſecret", "toKen", "\n", "-", "f" * 23, "token", "to"]
    for _ in range(4000):
        text = "".join(dice.choice(parts) for _ in range(dice.randint(1, 14)))
        assert [s[:3] for s in sec.base_spans(text)] == base(text), text


def test_automata_learn_formats():
    dice = random.Random(4)
    keys = ["sk_" + "".join(dice.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(24)) for _ in range(400)]
    automaton = sec.Automaton(keys)
    reached, todo = {0}, [0]
    while todo:
        for child in automaton.next[todo.pop()].values():
            if child not in reached:
                reached.add(child)
                todo.append(child)
    assert len(reached) < 60  # of thousands of states in the prefix tree
    new = "sk_" + "".join(dice.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(24))
    assert automaton.likelihood(new) > automaton.likelihood("Internationalisation") + 1
    assert automaton.likelihood(new) > automaton.likelihood("AB_" + new[3:])


def test_more_of_a_format_is_found(spark):
    dice = random.Random(5)
    key = lambda: "AKIA" + "".join(dice.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
    hidden = "akia" + key()[4:]
    rows = [(i, f"some words {key()} and internationalisation1234567 and 1234567890123456") for i in range(300)] + [(999, f"see AKIA{key()[4:]}x or {hidden}")]
    spans = {r["doc_id"]: r["spans"] for r in sec.scan(documents(spark, rows)).collect()}
    assert all([s["kind"] for s in spans[i]] == ["access"] for i in range(300))


def recall(spark, make, others):
    """Share of planted values that are found where no pattern finds them, with 300 labelled ones, and false finds among other words."""
    rows = [(i, f"the token = {make()} of {others[i % len(others)]}") for i in range(300)]
    planted = {1000 + i: make() for i in range(200)}
    rows += [(i, f"{others[i % len(others)]} see {v}, {others[i % 7]}") for i, v in planted.items()]
    found = {r["doc_id"]: [s["value"] for s in r["spans"] if s["kind"].startswith("format-")] for r in sec.scan(documents(spark, rows)).collect()}
    assert all(v in planted.values() for spans in found.values() for v in spans)
    return sum(v in found[i] for i, v in planted.items()) / len(planted)


def test_recall_of_planted_formats(spark):
    """Short values, values of letters alone, of digits alone, and long ones: no length and no mixture is asked for."""
    dice = random.Random(6)
    words = ["internationalisation", "licence", "Programmes", "university", "1234", "reading", "tokens", "2021-2022", "of_the"]
    for head, letters, n in (("tk", "bcdfghjklmnpqrstvwxz", 6), ("", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", 20), ("77", "0123456789", 6), ("sk_", "abcdefghijklmnopqrstuvwxyz0123456789", 30)):
        assert recall(spark, lambda: head + "".join(dice.choice(letters) for _ in range(n)), words) >= 0.9, head


def test_candidates_against_a_plain_loop():
    dice = random.Random(7)
    parts = ["abc", "0123456789abcdef" * 2, "token=", " ", "é", "x_y-z", "AKIA" + "A" * 16, ".", "word", "=="]
    for _ in range(2000):
        text = "".join(dice.choice(parts) for _ in range(dice.randint(1, 10)))
        spans = sec.base_spans(text)
        inside = [any(s[1] <= i < s[2] for s in spans) or not re.match(r"[A-Za-z0-9+/_=-]", c) for i, c in enumerate(text)] + [True]
        starts = [i for i in range(len(text)) if not inside[i] and (i == 0 or inside[i - 1])]
        runs = [(i, inside.index(True, i)) for i in starts]
        assert sec.candidates(text, spans, 4) == [r for r in runs if r[1] - r[0] >= 4], text


def test_the_rest_of_a_run_with_a_base_span_is_scored(spark):
    dice = random.Random(8)
    key = lambda: "".join(dice.choice("0123456789abcdef") for _ in range(24))
    rows = [(i, key()) for i in range(200)] + [(500, "_".join([key(), "QXQXQXQX" + "Z" * 30]))]
    spans = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in sec.scan(documents(spark, rows)).collect()}
    assert spans[500][0] == "hex" and "hex" in spans[0]


def test_likelihood_stops_early_without_change():
    dice = random.Random(9)
    values = ["".join(dice.choice("abc123") for _ in range(8)) for _ in range(100)]
    automaton = sec.Automaton(values)
    for value in values + ["zzzzzzzz", "a" * 50, "", "abc"]:
        plain = automaton.likelihood(value)
        bounded = automaton.likelihood(value, -2.0)
        assert bounded == plain if plain >= -2.0 else bounded < -2.0


def test_rows_and_query(spark):
    rows = AWKWARD + [(20, 'password = "hunter22" and token: abc123def'), (21, "0" * 24), (22, "x AKIA" + "A" * 16)]
    got = sec.scan(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for i, t in rows if i == r["doc_id"]) or ""
        assert [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] in sec.KINDS] == base(text)
        assert all(s["value"] in text for s in r["spans"])
    assert sec.scan(empty(spark)).count() == 0
    assert sec.scan(documents(spark)).count() == len(AWKWARD)  # nothing to learn from
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op3_secret_scan"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = base(texts[r["doc_id"]])
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[0] == k for s in spans) for k in sec.KINDS]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))
