from __future__ import annotations

import pytest

from fathomgrid.llm import sentences

CASES = [
    ["We met Dr. Vane at 9 a.m. on Monday.", "It cost approx. 3.5 credits, i.e. more.", "Done!"], ["The window closes at 9 p.m.", "Then it opens."], ["We saw tables, charts, etc.", "The rest is here."], ["Logs etc. are attached."], ["Step No. 7 failed.", "No.", "Really?!"],
    ['The reply said "Not yet." and nothing else.', "Next one."], ['The note read: "Stop. Roll back. Then call." in red letters.', 'The note read: "Stop. Go. Now." again.'], ["(The old page is wrong.)", "It goes on."], ["Wait... the job is running.", "It is slow...", "Then it ended."],
    ["npm install fails.", "eu-west is fine now."], ["Node.js and v1.2.3 differ.", "See https://a.b/c?d=1.html for details."], ["J. K. Vane wrote it.", "The U.S. region works."], ["Siehe Abb. 3 bzw. Kap. 4.2 im Bericht.", "Der 2. Lauf kostete 1.250,75 Punkte.", "Am 3. April um 9.30 Uhr startet es."],
    ["Das dauert ca. 3,5 Sekunden, d. h. länger.", "Bitte z. B. Zeile 4 prüfen."], ["„Halt. Erst prüfen.“ steht im Protokoll.", "Gut."], ["M. Vane lira la fig. 8 demain.", "Est-ce normal ?", "« Stop. On attend. » dit la note."], ["¿Es normal?", "La Sra. Vane llega a las 9.30 a. m. del lunes.", "«¿Está caído?», preguntó."],
    ["В 2024 г. было 9 тыс. записей.", "«Сервис упал?» — спросил дежурный.", "Журналы и т. д. приложены."], ["这正常吗？", "“先停下。再检查。”便条上这样写着。", "等等……还在运行。"], ["他说：“还没有。”", "升级以来很慢。"], ["本当ですか？！", "「止まりましたか？」と当番が聞きました。"], ["क्या यह सामान्य है?", "“क्या सेवा बंद है?” टीम ने पूछा।"], ["هل هذا طبيعي؟", "راجع د. فين السطر 4."],
]


@pytest.mark.parametrize("parts", CASES, ids=lambda p: p[0][:20])
def test_paragraphs(parts):
    dense = any("぀" <= c <= "鿿" for c in parts[0])
    for glue in ("",) if dense else (" ", "  ", "\n"):
        text = glue.join(parts)
        assert [text[a:b] for a, b in sentences.units(text)] == parts


def test_blocks():
    text = "# Title\nBody one. Body\ntwo.\n\n* item one. Still\n* item two\n\n```\na. B\n\nc\n```\n> Quoted. More\n\nHead\n====\nlast line"
    assert [text[a:b] for a, b in sentences.units(text)] == ["# Title", "Body one.", "Body\ntwo.", "* item one. Still", "* item two", "```\na. B\n\nc\n```", "> Quoted.", "More", "Head\n====", "last line"]


def test_thai_spaces():
    text = "งานแรก งานที่สอง 3 วัน\nงานสาม"
    assert [text[a:b] for a, b in sentences.units(text)] == ["งานแรก", "งานที่สอง 3 วัน", "งานสาม"]


def test_units_cover_everything_but_space():
    for text in ["  a. B. \r\n\r\n c", "…", "))) .. ((", '"""', "a b. C", "x" * 20_000 + ". Y", ". ".join(["Word goes"] * 3000)]:
        spans = sentences.units(text)
        assert all(a < b and text[a:b] == text[a:b].strip() for a, b in spans)
        assert "".join("".join(text[a:b] for a, b in spans).split()) == "".join(text.split())


def test_rows(spark):
    df = spark.createDataFrame([(1, "Ab cd. Ef gh.", 5), (2, None, 5), (3, " \n ", 5)], "doc_id long, text string, start_at int")
    assert sorted(map(tuple, sentences.split(df).collect())) == [(1, 0, 6), (1, 7, 13)]
    assert sentences.split(df.where("false")).count() == 0


def test_long_code_blocks_and_long_lists():
    code = "```\n" + "a = 1. Next b.\n\n" * 60_000 + "```"
    text = f"Before it. More here.\n\n{code}\n\nAfter it."
    assert [text[a:b] for a, b in sentences.units(text)] == ["Before it.", "More here.", code, "After it."]
    items = [f"{n}. Open the page. Then close it." for n in range(995, 1011)]
    text = "\n".join(items)
    assert [text[a:b] for a, b in sentences.units(text)] == items
    text = "2019. It was a good year. We left."
    assert len(sentences.units(text)) > 1


@pytest.mark.parametrize("text", ["a " + "." * 50_000 + "x b. C", "a " + "»" * 50_000 + "x", "z. B. " * 20_000, "“a. " * 20_000, "x. " + " " * 100_000 + "y", "> a. " * 20_000, "a b. " * 100_000])
def test_long_odd_paragraphs_take_linear_time(text):
    import time

    began = time.perf_counter()
    spans = sentences.units(text)
    assert time.perf_counter() - began < 10
    assert "".join("".join(text[a:b] for a, b in spans).split()) == "".join(text.split())
