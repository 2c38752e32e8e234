from __future__ import annotations

import random

import pytest

from fathomgrid.llm import people

ATTRIBUTES = ["email", "name", "first_name", "last_name", "github_login", "slack_display_name", "slack_username", "jira_display_name"]


def frame(spark, rows):
    data = [(i, s, *[r.get(a) for a in ATTRIBUTES], "extra") for i, s, r in rows]
    return spark.createDataFrame(data, "rec_id long, source string, " + ", ".join(f"{a} string" for a in ATTRIBUTES) + ", person string")


def groups(spark, rows):
    out: dict[str, set] = {}
    for r in people.match(frame(spark, rows)).collect():
        out.setdefault(r.person, set()).add(r.rec_id)
        assert 0 < r.confidence <= 1
    return {frozenset(v) for v in out.values()}


FIRST = "Kamira Tavora Brikesh Lomund Fensander Galthea Orrico Petane Ylvora Duzef".split()
LAST = "Velneshadal Branmitalund Casdevonko Grukuriiya Zarmineoun Limtamiford Quendebaberg Sorbadehara Halristad Norderitani".split()


def typo(r, first, last):
    at = r.randrange(1, len(last) - 2)
    return f"{first} " + r.choice((last[:at] + last[at + 1] + last[at] + last[at + 2 :], last[:at] + last[at + 1 :], last[:at] + "x" + last[at + 1 :], last[:at] + last[at] + last[at:]))


def test_dirty_records_of_known_people(spark):
    r = random.Random(1)
    persons = [(f, x) for f in FIRST for x in LAST]
    rows, truth, n = [], [], 0
    for f, x in persons:
        ids = set()
        kinds = [{"email": f"{f}.{x}@corp.test".lower()}, {"jira_display_name": f"{x}, {f}"}, {"github_login": r.choice([f"{f}{x}", f"{x}{f}", f"{f}-{x}-dev"]).lower()}, {"slack_display_name": r.choice([f"{f} {x} (OOO)", f"{f.upper()} {x.upper()}", typo(r, f, x)])}]
        for k, record in enumerate(kinds):
            n += 1
            rows.append((n, ("slack", "jira", "github", "slack2")[k], record))
            ids.add(n)
        truth.append(frozenset(ids))
    got = groups(spark, rows)
    assert len(got & set(truth)) >= 0.97 * len(truth)


def test_namesakes_shared_mailboxes_and_scripts(spark):
    filler = [(100 + i, "jira", {"jira_display_name": f"{f} {x}"}) for i, (f, x) in enumerate((f, x) for f in FIRST[:6] for x in LAST[5:])]
    rows = [
        (1, "slack", {"slack_display_name": "Durvin A. Grurikuzu"}), (2, "jira", {"email": "durvin.a.grurikuzu@corp.test"}), (3, "slack", {"slack_display_name": "Durvin E. Grurikuzu"}), (4, "github", {"github_login": "durvinegrurikuzu"}),
        (5, "slack", {"email": "build-farm-1@corp.test", "name": "Petane Velneshadal"}), (6, "jira", {"email": "BUILD-FARM-1@corp.test", "name": "Ylvora Casdevonko"}), (7, "github", {"name": "Ylvora Casdevonko"}), (8, "github", {"github_login": "quietkettle73"}), (9, "jira", {"jira_display_name": "Петане Велнешадал"}),
        (10, "slack", {}), (11, "slack", {"email": "zz@own.test"}), (12, "jira", {"email": "ZZ+tag@own.test", "name": "Kamira Branmitalund"}), (12, "jira", {"email": "ZZ+tag@own.test", "name": "Kamira Branmitalund"}),
    ]
    got = groups(spark, rows + filler)
    for want in ({1, 2}, {3, 4}, {5, 9}, {6, 7}, {8}, {10}, {11, 12}):
        assert any(want <= g and not (g - want) & set(range(1, 13)) for g in got), want


@pytest.mark.parametrize("hot", [people.HOT, 0, 30])
def test_near_pairs_are_exact(spark, hot, monkeypatch):
    monkeypatch.setattr(people, "HOT", hot)
    r = random.Random(2)
    words = {"".join(r.choice("abcde") for _ in range(r.randint(4, 9))) for _ in range(150)}
    df = spark.createDataFrame([(w, True, True) for w in words], "text string, lhs boolean, rhs boolean")
    got = {tuple(x) for x in people.near_pairs(df).collect()}
    want = {(a, b) for a in words for b in words if a != b and len(people.features(a) ^ people.features(b)) <= people.RADIUS}
    assert got == want and want


def test_pairs_and_empty(spark):
    persons = spark.createDataFrame([(1, "a", "p", 1.0), (3, "b", "p", 0.5), (2, "a", "p", 1.0), (4, "b", "q", 1.0)], "rec_id long, source string, person string, confidence double")
    assert {tuple(r) for r in people.pairs(persons).collect()} == {(1, 3, 0.5), (2, 3, 0.5)}
    assert people.match(frame(spark, [])).count() == 0


def test_large_groups_of_one_address(spark):
    one = [(i, "github", {"email": "bytefox401@own.test", "github_login": f"bytefox{i}"}) for i in range(12)] + [(12, "slack", {"email": "BYTEFOX401@own.test", "name": "Kamira Branmitalund"})]
    odd = {0: "Tarvin Okendenedal", 1: "Ylvora Casdevonko"}
    copies = [(100 + i, "jira", {"email": "lynx77@own.test", "name": odd.get(i, "Petane Velneshadal")}) for i in range(30)] + [(130, "github", {"email": "lynx77@own.test"})]
    shared = [(200 + i, "slack", {"email": "roof9@own.test", "name": n}) for i, n in enumerate(["Durvin Grurikuzu", "Hadoro Velbalotani", "Nephie Ingmibaberg"] * 4)] + [(220, "github", {"email": "roof9@own.test"})]
    rows = [(i, s, *[a.get(c) for c in ATTRIBUTES]) for i, s, a in one + copies + shared]
    df = spark.createDataFrame(rows, "rec_id long, source string, " + ", ".join(f"{c} string" for c in ATTRIBUTES))
    person = {r.rec_id: r.person for r in people.match(df).collect()}
    assert len({person[i] for i in range(13)}) == 1 and len({person[i] for i in range(100, 131)}) == 1
    assert len({person[i] for i in (*range(200, 212), 220)}) == 4 and len(set(person.values())) == 6


def test_confidence_is_the_rate_of_agreement(spark):
    """Votes of spellings that the addresses contradict lose their confidence and join no record; a second attribute for another anchor lowers the score."""
    vote = lambda field, anchor, kind, dice: {"field": field, "anchor": anchor, "kind": kind, "dice": dice}
    rows = [(i, "s", [vote("email", f"a{i}|", "same", 1.0), vote("slack_display_name", f"b{i}|", "typo", 0.85)]) for i in range(40)]
    rows += [(100 + i, "s", [vote("email", f"c{i}|", "same", 1.0), vote("name", f"c{i}|", "typo", 0.95)]) for i in range(40)]
    rows += [(900, "s", [vote("slack_display_name", "x|", "typo", 0.85)]), (901, "s", [vote("name", "y|", "typo", 0.95)]), (902, "s", [vote("name", "y|", "typo", 0.9), vote("slack_display_name", "z|", "typo", 0.9)])]
    told = spark.createDataFrame(rows, "rec_id long, source string, votes array<struct<field:string,anchor:string,kind:string,dice:double>>")
    scores = {(r.rec_id, r.anchor): r.score for r in people._weighed(told).collect()}
    assert scores[900, "x|"] == pytest.approx(0.85) and scores[902, "y|"] == pytest.approx(2.5 * 0.9 / 4.5) and scores[902, "z|"] == pytest.approx(2.0 * 0.9 / 4.5)
    sure = {(r.rec_id, r.anchor): r.confidence for r in people._confident(people._weighed(told)).collect()}
    assert sure[900, "x|"] < people.CONFIDENT < 0.9 < sure[901, "y|"] and sure[0, "a0|"] > 0.949 and sure[100, "c0|"] > 0.99
