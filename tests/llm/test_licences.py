import re

from helpers import AWKWARD, documents, empty

from rollbook.llm import licences, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def base(text):
    words = WORD.findall(lower(text))
    starts = [(k, label) for phrase, label in licences.PHRASES for k in range(len(words))
              if words[k:k + len(phrase.split())] == phrase.split()]
    at = [k for k, _ in starts]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in starts}))


def test_base_places():
    scanner = licences.Scanner()
    texts = ["cc by cc by-nc CC  BY", "gnu general public gnu general public license license", "the apache license", "mit\nlicense,mit license",
             "ccby cc-by cc_by ccéby cc é by", "", "GNU GENERAL PUBLIC LICENSE", "apache apache license license", "mit licenses"]
    for text in texts + [t for _, t in AWKWARD]:
        got = scanner.scan(text or "")
        assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"], ",".join(got["base_labels"])) == base(text), text


def test_spans_survive_small_changes():
    text = dict((label, t) for label, t in reversed(licences.TEXTS))["mit"]
    words = text.split()
    changed = " ".join(["noise"] * 7 + words[:20] + ["inserted", "words"] + words[21:] + ["noise"] * 7)
    got = licences.Scanner().scan(changed)
    span = next(s for s in got["spans"] if s["label"] == "mit")
    assert span["cover"] > 0.9 and span["first_word"] == 7 and got["score"] == span["cover"]
    assert licences.Scanner().scan("of the software and the rights to use it")["labels"] == []


def test_matching_statistics_equal_brute_force():
    """Streaming whole stretches finds the same matches as looking at every place."""
    scanner = licences.Scanner()
    texts = [t for t, _ in scanner.texts]
    dice = __import__("random").Random(2)
    for _ in range(60):
        ids = []
        while len(ids) < 120:
            t = dice.choice(texts)
            a = dice.randrange(len(t))
            ids += t[a:a + dice.randint(1, 15)] + [0] * dice.randint(0, 2)
        longest = 0
        best = []
        for end in range(1, len(ids) + 1):
            longest = min(longest + 1, end)
            while longest and not any(t[p:p + longest] == ids[end - longest:end] for t in texts + [p for p, _ in scanner.phrases] for p in range(len(t))):
                longest -= 1
            best.append(longest)
        state = matched = 0
        for end, symbol in enumerate(ids, 1):
            state, matched = scanner.automaton.step(state, matched, symbol)
            assert matched == best[end - 1]


def test_rows_and_query(spark):
    got = licences.scan(documents(spark)).collect()
    assert len(got) == len(AWKWARD)
    assert sorted((r["doc_id"], r["n_words"]) for r in got) == sorted((i, base(t)[0]) for i, t in AWKWARD)
    assert licences.scan(empty(spark)).count() == 0
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op2_licence_scan"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base(texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
