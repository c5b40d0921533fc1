"""Subject areas: sentences, held-out accuracy on generated documents and on reviewed ones, odd input."""

import random

import pandas as pd

from specloom.llm.subjects import MAX_LABELLED, document_subjects, labelled_sample, predict, sentences, source_name, terms, train

WORDS = {"power": ["busbar trips", "inverter holds load", "rectifier converts voltage"], "cooling": ["pump moves coolant", "fan removes heat", "chiller cools water"], "law": ["clause limits liability", "contract ends early", "warranty covers parts"]}
PLAIN = ["the page is new", "see the next sheet", "figures are typical"]


def document(r, subjects, n=12, passing=None):
    parts = [r.choice(WORDS[s]) for s in subjects for _ in range(n // max(len(subjects), 1) if subjects else 0)]
    parts += [r.choice(PLAIN) for _ in range(2)] + ([r.choice(WORDS[passing])] if passing else [])
    r.shuffle(parts)
    return "Model X-1\n" + " ".join(p.capitalize() + "." for p in parts)


def corpus(n, seed):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        subjects = r.sample(sorted(WORDS), r.choice([1, 1, 2]))
        others = sorted(set(WORDS) - set(subjects))
        out.append((document(r, subjects, passing=r.choice(others + [None])), r.choice(["a", "B_c"]), subjects))
    return out


def test_sentences_and_terms():
    got = sentences("Title line\nOne. Two two! - item one\n- item two\n价格。说明；续\nWhy so? Because.")
    assert [s for s, _ in got] == ["One.", "Two two!", "- item one", "- item two", "价格。", "说明；续", "Why so? Because."]
    assert [i for _, i in got] == [False, False, True, True, False, False, False]
    assert terms("Das Öl 5, ok") == ["das", "öl", "ok", "das öl", "öl ok"] and "价格" in terms("价格表")
    assert sentences("") == [] and source_name(" A_b c ") == "a-b-c" and source_name(None) == ""


def test_held_out_accuracy():
    data = corpus(400, 1)
    # A few wrong reviews.
    for i in range(0, 400, 25):
        data[i] = (*data[i][:2], ["law"])
    model = train(pd.DataFrame(data, columns=["text", "source", "subjects"]), sorted(WORDS))
    test = corpus(200, 2)
    got = predict(model, [t for t, _, _ in test], [source_name(s) for _, s, _ in test])
    assert sum(sorted(g) == sorted(s) for g, (_, _, s) in zip(got, test)) >= 190
    r = random.Random(3)
    none = predict(model, [document(r, []) for _ in range(20)], ["a"] * 20)
    assert sum(map(len, none)) <= 2
    assert predict(model, ["", "Headline only", "x" * 100_000], ["", "", ""]) == [[], [], []]


def test_odd_input(spark):
    d = spark.createDataFrame([(1, None, "s", 1), (2, "", None, 1), (3, corpus(1, 1)[0][0] * 50, "s", 1)], "doc_id long, text string, source string, subject int")
    names = spark.createDataFrame([("power",), (None,), ("law",), ("cooling",)], "subject string")
    none = spark.createDataFrame([], "doc_id long, subject string")
    assert document_subjects(d, none, names).collect() == []
    labels = [(i + 10, s) for i, (_, _, subjects) in enumerate(corpus(60, 4)) for s in subjects]
    more = spark.createDataFrame([(i + 10, t, s, 1) for i, (t, s, _) in enumerate(corpus(60, 4))], d.schema).union(d)
    reviewed = spark.createDataFrame(labels + labels[:5] + [(None, "law"), (11, None), (999, "law")], "doc_id long, subject string")
    got = {x.doc_id for x in document_subjects(more, reviewed, names).collect()}
    assert 1 not in got and 2 not in got and len(got) >= 55
    assert document_subjects(more.limit(0), reviewed, names).collect() == []
    assert len(labelled_sample(more, reviewed, 7)) == 7 and MAX_LABELLED == 6_000


def test_reviewed_documents(spark, sf_dir):
    """On the test tables most documents get the subjects that reviewers gave them."""
    t = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "subject_labels", "subjects")}
    got = {}
    for x in document_subjects(t["documents"], t["subject_labels"], t["subjects"]).collect():
        got.setdefault(x.doc_id, set()).add(x.subject)
    want = {}
    for x in t["subject_labels"].collect():
        want.setdefault(x.doc_id, set()).add(x.subject)
    assert sum(bool(got.get(k, set()) & v) for k, v in want.items()) >= 0.8 * len(want)
