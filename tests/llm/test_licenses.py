import random
import re

from helpers import awkward, awkward_rows, empty, fold

from wordloom.llm import licenses
from wordloom.llm.licenses import LEAST_RUN, PHRASES, TEMPLATES, automaton, scan_licenses, scan_text, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words, places = WORD.findall(fold(text)), []
    for which, (phrase, _) in enumerate(PHRASES):
        parts = phrase.split()
        places += [(at, which) for at in range(len(words)) if words[at : at + len(parts)] == parts]
    return len(words), sorted(places)


def made_texts(count):
    rng = random.Random(5)
    texts = [text.split() for text, _ in (*PHRASES, *TEMPLATES)]
    vocabulary = [word for words in texts for word in words]
    for _ in range(count):
        words = []
        for _ in range(rng.randint(0, 12)):
            if rng.random() < 0.5:
                words += rng.choices(vocabulary, k=rng.randint(1, 4))
            else:
                part = rng.choice(texts)
                at = rng.randrange(len(part))
                words += part[at : at + rng.randint(1, 12)]
        yield " ".join(rng.choice((word, word.upper(), word + ".", word + "é")) for word in words)


def test_phrases_equal_the_plain_search():
    for text in made_texts(300):
        assert scan_text(text)[:2] == plain(text)


def test_runs_are_the_matching_statistics():
    texts = [words_of(text) for text, _ in (*PHRASES, *TEMPLATES)]
    runs = {tuple(t[a:b]) for t in texts for a in range(len(t)) for b in range(a + 1, len(t) + 1)}
    machine = automaton(PHRASES, TEMPLATES)
    for text in made_texts(60):
        words = words_of(text)
        longest = [
            max(n for n in range(at + 2) if n == 0 or tuple(words[at + 1 - n : at + 1]) in runs)
            for at in range(len(words))
        ]
        wanted = [
            (at + 1 - n, n)
            for at, n in enumerate(longest)
            if n >= LEAST_RUN and (at + 1 == len(longest) or longest[at + 1] <= n)
        ]
        assert [(start, length) for start, length, _ in machine.scan(words)[1]] == wanted


def test_chains_survive_small_changes():
    text = TEMPLATES[3][0].replace("free of charge", "at no cost")
    (span,) = scan_text("some words before " + text + " and after")[2]
    assert TEMPLATES[span.template][1] == "mit" and span.start == 3 and 0.9 < span.cover < 1
    assert scan_text(" ".join(TEMPLATES[3][0].split()[:30]))[2] == []


def test_short_statements_stand_beside_longer_templates():
    statement = "Licensed under the Apache License, Version 2.0"
    for after in ("", ". The code is", ' (the "License")', " (the License) you may", ". Permission is hereby granted"):
        (span,) = scan_text(f"some code {statement}{after} here")[2]
        assert (TEMPLATES[span.template][1], span.start, span.end, span.cover) == ("apache-2.0", 2, 10, 1.0)
    assert {(s.start, s.end, s.template) for s in scan_text(TEMPLATES[1][0])[2]} == {(0, 8, 0), (0, 86, 1)}


def test_matches_are_all_agreements_of_text_and_template():
    texts = [words_of(text) for text, _ in TEMPLATES]
    machine = automaton(PHRASES, TEMPLATES)
    for text in made_texts(60):
        words, wanted = words_of(text), set()
        for which, there in enumerate(texts, len(PHRASES)):
            for at in range(len(words)):
                for end in range(len(there)):
                    n = 0
                    while at + n < len(words) and end + n < len(there) and words[at + n] == there[end + n]:
                        n += 1
                    if n >= LEAST_RUN and not (at and end and words[at - 1] == there[end - 1]):
                        wanted.add((at, n, which, end + n))
        found = machine.scan(words)[2]
        assert len(found) == len(wanted) and set(found) == wanted


def test_runs_that_do_not_fit_leave_a_chain_open():
    templates = (("a b c d e f g h i j k l", "x"), ("d e f z", "y"))
    for between in ("a b c", "d e f z", "q"):
        spans = scan_text(f"a b c d e f {between} g h i j k l", (), templates)[2]
        assert [(s.start, s.cover) for s in spans if s.template == 0] == [(0, 1.0)]
    twice = scan_text(f"{templates[0][0]} {templates[0][0]}", (), templates)[2]
    assert [(s.start, s.end) for s in twice if s.template == 0] == [(0, 12), (12, 24)]
    assert scan_text("a b c d e f" + " q" * 13 + " g h i j k l", (), templates[:1])[2] == []


def test_awkward_rows(spark):
    rows = awkward_rows() + [(50, "Licensed under CC BY-NC 4.0. All rights reserved.", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, score bigint")
    found = scan_licenses(docs.withColumnRenamed("lang", "labels")).collect()
    assert len(found) == len(rows)
    wanted = []
    for doc_id, text, *_ in rows:
        count, places = plain(text)
        starts = [at for at, _ in places]
        base = ",".join(sorted({PHRASES[which][1] for _, which in places}))
        wanted.append((doc_id, count, len(places), min(starts, default=None), max(starts, default=None), base))
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(row)[:6]) for row in found)
    row = next(row for row in found if row["doc_id"] == 50)
    assert row["labels"] == "cc-by,cc-by-nc-4.0,reserved" and row["score"] == 1.0
    assert scan_licenses(awkward(spark, ["labels", "n_base"])).count() == len(awkward_rows())
    assert scan_licenses(empty(spark)).collect() == []


def test_own_phrases_and_templates(spark):
    docs = spark.createDataFrame([(1, "Do what you like. Do what you like")], "doc_id bigint, text string")
    found = scan_licenses(docs, (("what you", "free"),), (("do what you like", "wtf"),)).first()
    assert (found["n_base"], found["first_word"], found["last_word"], found["labels"]) == (2, 1, 5, "free,wtf")
    assert licenses.scan_text("a b", (("a b", "x"),), ())[1] == [(0, 0)]
