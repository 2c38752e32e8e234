from __future__ import annotations

import random

from fathomgrid.llm import leakage

WORDS = [f"w{a}{b}" for a in "bcdfgh" for b in "aeiou"]


def brute(item: list[str], doc: list[str], edits: int = 1) -> bool:
    """Whether 12 to 19 consecutive words of the item stand in the document with at most one word replaced, dropped or added."""

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    spans = {tuple(doc[i : i + n]) for n in range(11, 21) for i in range(len(doc) - n + 1)}
    return any(abs(len(s) - n) <= 1 and s[0] == w[0] and s[-1] == w[-1] and distance(w, list(s)) <= edits for n in range(12, 20) for i in range(len(item) - n + 1) for w in [item[i : i + n]] for s in spans)


def found(spark, items: list[str], docs: list[str | None]) -> set[tuple[int, int]]:
    """Numbers of items and documents that leak."""
    a = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    b = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    return {tuple(r) for r in leakage.leaks(a, b).collect()}


def test_same_as_brute_force_for_single_edits(spark):
    r = random.Random(5)
    cases = []
    for case in range(60):
        item = [r.choice(WORDS) + str(r.randrange(99)) for _ in range(24)]
        n = r.choice((9, 10, 11, 12, 13, 15))
        a = r.randrange(len(item) - n)
        part = item[a : a + n]
        for _ in range(r.choice((0, 0, 1, 1, 2))):
            at = r.randrange(1, len(part) - 1)
            part = r.choice((part[:at] + part[at + 1 :], [*part[:at], "zzz", *part[at + 1 :]], [*part[:at], "yyy", *part[at:]]))
        cases.append((item, ["x"] * r.randrange(4) + part + ["y"] * 3))
    got = found(spark, [" ".join(i) for i, _ in cases], [" ".join(d) for _, d in cases])
    assert got == {(k, k) for k, (i, d) in enumerate(cases) if brute(i, d)}


def test_rarest_seeds_of_each_run_guarantee_a_hit(spark):
    """Each clean run of a passage holds a kept seed, whatever the counts."""
    r = random.Random(3)
    tokens = [f"w{i}" for i in range(40)]
    prepared = leakage._prepared(spark.createDataFrame([(1, " ".join(tokens))], "item long, text string"))
    hashes = prepared.first()["hashes"]
    counts = spark.createDataFrame([(h, r.randrange(1, 50)) for h in hashes], "hash long, n long")
    kept = {x["hash"] for x in leakage.rare_seeds(prepared, counts).collect()}
    starts = [i for i, h in enumerate(hashes) if h in kept]
    run, seed = leakage.RUN[0], leakage.SEED[0]
    assert all(any(s <= i <= s + run - seed for i in starts) for s in range(len(tokens) - run + 1))
    n = {x["hash"]: x["n"] for x in counts.collect()}
    assert sum(n[h] for h in kept) < 0.7 * sum(n.values())


PASSAGE = "Operators of Draxithnode must confirm the jarnexap seal twice within two thousand olmekarnet minutes every single day"


def test_writing_does_not_matter(spark):
    forms = [
        PASSAGE.upper(), PASSAGE.replace(" ", " "), "> " + PASSAGE.replace(" seal", "\n> seal"), "| " + " | ".join(PASSAGE.split()) + " |", PASSAGE.replace("node", "no​de").replace("olmek", "ol­mek"), "<b>" + PASSAGE.replace("seal", "<i>seal</i>") + "</b>", PASSAGE.replace("jarnexap", "**jarnexap**"),
        "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in PASSAGE), PASSAGE.replace(" must", "&nbsp;must"), PASSAGE.replace("confirm the", "confirm, the").replace("Draxithnode", "Draxíthnode"), PASSAGE.replace("within ", ""),
    ]
    none = ["", None, " ", "Operators of Draxithnode must confirm the jarnexap seal twice", "Nobody says must confirm the jarnexap seal here"]
    docs = spark.createDataFrame(list(enumerate(forms + none)), "doc_id long, text string")
    items = spark.createDataFrame([(7, PASSAGE + ". What now?"), (7, PASSAGE + ". What now?"), (8, "So: " + PASSAGE), (9, None), (10, "too short")], "item_id long, text string")
    want = {(i, d) for i in (7, 8) for d in range(len(forms))}
    assert {tuple(r) for r in leakage.leaks(items, docs).collect()} == want
    assert leakage.leaks(items.where("false"), docs).count() == 0


def test_characters_of_dense_scripts(spark):
    item = "当系统失去租约时另一台服务器会按顺序重放八千七百五十五个数据帧然后关闭窗口"
    edited = item[2:12] + "另" + item[13:30]
    docs = ["前言。" + item[3:28] + "。后记", " ".join(item[3:28]), item[3:26], edited]
    assert found(spark, [item], docs) == {(0, 0), (0, 1), (0, 3)}


def test_sentences_with_other_names_are_no_leak(spark):
    make = "当{}失去{}租约时，{}会按顺序重放{}个{}帧。{}在{}窗口关闭之前把第{}批{}数据发送给{}。".format
    item = make("Olmekondavault", "olmekaxilon", "Draxarnlattice", 6856, "wexilephet", "Olmekondavault", "vellondaom", 2487, "skarnithak", "Draxarnlattice")
    other = make("Pholundravault", "quorondaas", "Zintithhub", 8416, "tuveaxilad", "Pholundravault", "draxembal", 2017, "skarnembep", "Zintithhub")
    half = item.split("。")[0]
    one = half.replace("wexilephet", "tuveaxilad")  # one word of nineteen
    spaced = " ".join(half)
    english = "Operators of {} must confirm the {} seal twice within {} {} minutes every day".format
    docs = [other, half, one, spaced, english("Quoriskanode", "tuveithap", 4089, "skarnulous")]
    assert found(spark, [item, english("Draxithnode", "jarnexap", 8755, "olmekarnet")], docs) == {(0, 1), (0, 2), (0, 3)}


def test_long_tags_links_and_texts(spark):
    words = PASSAGE.split()
    for n in (200, 300, 400, 5000):
        tag = f'<a href="https://host.example/{"x" * n}">{words[5]}</a>'
        link = f'[{words[5]}](https://host.example/{"y" * n})'
        docs = [" ".join([*words[:5], t, *words[6:]]) for t in (tag, link)]
        assert found(spark, [PASSAGE], docs) == {(0, 0), (0, 1)}, n
    filler = " ".join(f"f{i}" for i in range(30_000))
    long_item = " ".join(f"q{i}" for i in range(3000))
    docs = [f"{filler} {PASSAGE} {filler}", " ".join(f"q{i}" for i in range(955, 967)), " ".join(f"q{i}" for i in range(1020, 1032)), long_item]
    assert found(spark, [PASSAGE, long_item], docs) == {(0, 0), (1, 1), (1, 2), (1, 3)}


def test_odd_texts_take_linear_time():
    import time

    began = time.perf_counter()
    for text in ("a-" + "\n" * 200_000 + "1", "<" * 200_000, "<!--" * 50_000, "](" * 100_000, "[a" * 100_000, "x-\n" * 60_000):
        leakage.words(text)
    assert time.perf_counter() - began < 10
