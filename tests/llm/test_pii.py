from __future__ import annotations

import random

import pytest

from fathomgrid.llm import pii


@pytest.fixture(scope="module")
def field():
    return pii.model()


def test_held_out_accuracy(field, monkeypatch):
    monkeypatch.setattr(pii, "SEED", 4242)
    monkeypatch.setattr(pii, "SENTENCES", 600)
    rows, _, common = pii._table()
    field.common, field.types = common, {}
    field.table = field.table[:, :0]
    tp = fp = fn = 0
    for (text, spans), got in zip(rows, pii.find([r[0] for r in rows], field)):
        want, have = {(k, s) for s, _, k in spans}, {(k, s) for k, s, _ in got}
        tp, fp, fn = tp + len(want & have), fp + len(have - want), fn + len(want - have)
    assert tp / (tp + fp) > 0.95 and tp / (tp + fn) > 0.95


def test_forms_and_traps(field):
    field.common, field.types = frozenset("the report shows values after restart server drops page build host order number is a sample".split()), {}
    field.table = field.table[:, :0]
    cases = {
        "Mail ann.lee@corp.test now.": [("email", "ann.lee@corp.test")], "Bitte an ann22 [at] mail [dot] corp [dot] test weiterleiten.": [("email", "ann22 [at] mail [dot] corp [dot] test")], "Call +1 (415) 555-0132 if the job stops.": [("phone", "+1 (415) 555-0132")], "The form shows passport QQ 12 34 56 C in clear text.": [("id_number", "QQ 12 34 56 C")],
        "Ship to Tavora Quendeba, Flat 3, 12 Mill Road, Lakemont (gate 2).": [("person_name", "Tavora Quendeba"), ("address", "Flat 3, 12 Mill Road, Lakemont")], "cc @Brikesh Lomundar, see above": [("person_name", "Brikesh Lomundar")], "Order number 100-200-3000 is a sample.": [], "Remote is git@code.corp.test:team/app.git here.": [], "Host 10.0.3.4 answered in 5.5 ms.": [], "Use the @Override marker and @quartz/ledger 2.10.2.": [], "": [],
    }
    for text, want in cases.items():
        assert [(k, text[s:e]) for k, s, e in pii.find([text], field)[0]] == want, text
    assert pii.mask("Mail ann.lee@corp.test now.", [("email", 5, 22)]) == "Mail [EMAIL] now." and pii.mask(None, []) is None


def test_gradient_of_the_field():
    """Marginals of the forward-backward pass are those of all label sequences, counted one by one."""
    import itertools

    import numpy as np

    r = np.random.default_rng(0)
    f = pii.Field()
    n, t = len(pii.LABELS), 3
    emit = r.normal(size=(1, t, n)).astype(np.float32)
    pairs = (r.normal(size=(n, n)) + np.where(f.allowed, 0, -1e4)).astype(np.float32)
    marginal, _, _ = f._marginals(emit, pairs, np.ones((1, t), bool))
    want, total = np.zeros((t, n)), 0.0
    for y in itertools.product(range(n), repeat=t):
        p = np.exp(f.begin[y[0]] + sum(emit[0, i, y[i]] for i in range(t)) + sum(pairs[y[i], y[i + 1]] for i in range(t - 1)))
        total += p
        for i in range(t):
            want[i, y[i]] += p
    assert np.allclose(marginal[0], want / total, atol=1e-4)


def test_rows(spark):
    schema = "load_id long, kind string, summary string, description_text string, comments array<struct<id:string,body_text:string>>"
    long = " ".join(["The report shows the old values after a restart."] * 4000)
    rows = [(1, "clash", "Request from ann.lee@corp.test about labels", None, [("1", "Call 415-555-0132 if the job stops."), None, ("2", "")]), (2, None, "", long, None), (2, None, None, None, [])]
    df = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, pii.detect(pii.fields(df)).drop("end_at").collect()))
    assert got == [(1, "body_text", 0, "phone", 5), (1, "summary", -1, "email", 13)]
    texts = {(r.field, r.comment_pos): r.text for r in pii.redact(pii.fields(df)).where("load_id = 1").collect()}
    assert texts == {("summary", -1): "Request from [EMAIL] about labels", ("body_text", 0): "Call [PHONE] if the job stops."}
    assert pii.detect(pii.fields(df.where("false"))).count() == 0


def test_windows_lose_no_token():
    r = random.Random(1)
    words = [r.choice(["a", "b", ".", "\n"]) for _ in range(3000)]
    covered = [i for a, b in pii._windows(words) for i in range(a, b)]
    assert covered == [i for i, w in enumerate(words) if w != "\n"]


def test_names_said_often_stay_names(spark):
    rest = ["The report shows the old values after a restart.", "A slow job hides the list for guest accounts.", "Our team checks the table with more than ten replies."]
    said = ["Please ping Hadoro Velbalotani again.", "As discussed with Hadoro Velbalotani the fix can wait.", "Spoke with V. Branmitalund about the rollback."]
    rows = [(i, "summary", -1, t) for i, t in enumerate((rest * 10 + said) * 8)]
    texts = spark.createDataFrame(rows, "load_id long, field string, comment_pos int, text string")
    assert {"hadoro", "velbalotani", "branmitalund"} <= pii.common_words(texts)
    want = sorted((i, "person_name", t.index(v)) for i, _, _, t in rows for v in ("Hadoro", "V. B") if v in t)
    assert sorted((r.load_id, r.kind, r.start_at) for r in pii.detect(texts).collect()) == want


def test_long_lines_are_decoded_whole(field):
    field.common, field.types = frozenset("report shows values after restart".split()), {}
    field.table = field.table[:, :0]
    for n in range(150, 170):
        for fill in ("the report shows values after a restart ", "the report . shows values . after a restart "):
            words = (fill * 40).split()[:n]
            before = " ".join(words)
            text = f"{before} Please ping V. Lomundar again and call +1 (415) 555-0132 if the job stops " + fill * 20
            want = [("person_name", "V. Lomundar"), ("phone", "+1 (415) 555-0132")]
            assert [(k, text[s:e]) for k, s, e in pii.find([text], field)[0]] == want, n
    far = fill * 6000 + "Please ping V. Lomundar again"
    assert [(k, far[s:e]) for k, s, e in pii.find([far], field)[0]] == want[:1]


def test_odd_lines_take_linear_time():
    import time

    began = time.perf_counter()
    field = pii.model()
    for text in ("/" * 20_000 + "x", "%40" * 8_000 + "x", "a." * 10_000 + " me@x.test", "-" * 20_000):
        pii.find([text], field)
    assert time.perf_counter() - began < 60
