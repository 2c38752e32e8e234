from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from fathomgrid.functions import hashing, recognizers, text
from fathomgrid.functions.keys import flexible_time, normal_key
from fathomgrid.functions.recognizers import Span


def values(spark, items, kind, *columns):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, v {kind}")
    return [tuple(r)[0] if len(columns) == 1 else tuple(r) for r in df.orderBy("i").select(*columns).collect()]


def test_keys_and_times(spark):
    assert values(spark, [" ab-1\t", "　x﻿", " ", "", None], "string", normal_key(F.col("v"))) == ["AB-1", "X", None, None, None]
    times = ["2026-01-02T03:04:05.678+0530", "2026-01-02T03:04:05.678+05:30", "2026-01-01T21:34:05.678Z", "2026-01-01 21:34:05.678", "1767303245678", "page_3", "", None, "2026-13-01T00:00:00Z"]
    got = values(spark, times, "string", F.unix_millis(flexible_time(F.col("v"))))
    assert got == [1767303245678] * 5 + [None] * 4


def sha(salt, v, n):
    return hashlib.sha256((salt + v).encode()).hexdigest()[:n]


def test_hashes(spark):
    v = F.col("v")
    got = values(spark, ["ann@b.c@d.e", "ann", "", None], "string", hashing.email(v, F.lit("x.y")), hashing.login(v), hashing.local_part(v), hashing.domain_part(v))
    salt = hashing.GITHUB_SALT
    assert got[0] == (sha(salt, "ann@b.c", 8) + "@x.y", "user-" + sha(salt, "ann@b.c@d.e", 10), "ann@b.c", "d.e")
    assert got[1] == (sha(salt, "ann", 12), "user-" + sha(salt, "ann", 10), "ann", None)
    assert got[2][:2] == ("", "") and got[3] == (None, None, None, None)
    urls = values(spark, ["https://github.com/ann/x?y", "https://else.test/ann"], "string", hashing.profile_url(v))
    assert urls == [f"https://github.com/user-{sha(salt, 'ann', 10)}/x?y", "https://else.test/ann"]


def test_stand_ins_keep_their_form(spark):
    forms = {"PHONE_NUMBER": r"\[PHONE-[0-9a-f]{6}\]", "IP_ADDRESS": r"10\.0\.\d{1,3}\.\d{1,3}", "IN_PAN": "ZZZZZ[0-9A-F]{4}Z", "IN_AADHAAR": r"\d{4} \d{4} \d{4}", "IN_BANK_ACCOUNT": r"\d{14}", "GEO_COORDINATE": r"-?\d+\.0000,-?\d+\.0000", "OTHER": r"\[OTHER-[0-9a-f]{8}\]", "IN_IFSC": "XXXX0[0-9A-F]{6}", "IN_GST": "00ZZZZZ0000Z1Z[0-9A-F]", "IN_UPI_ID": "user.[0-9a-f]{8}@redacted"}
    for kind, form in forms.items():
        a, b = values(spark, ["one", "two"], "string", hashing.stand_in(kind, F.col("v")))
        assert re.fullmatch(form, a) and re.fullmatch(form, b) and (a != b or kind == "IN_GST")
    names = values(spark, ["Ann", "ANN", "Bob", "", None], "string", hashing.invented_name(F.col("v")))
    assert names[0] == names[1] != names[2] and names[3:] == ["", None]


def test_texts(spark):
    v = F.col("v")
    assert values(spark, ["a/b?.txt", " .. ", "x" * 300 + ".pdf", None], "string", text.file_name(v)) == ["a_b_.txt", "unnamed", "x" * 196 + ".pdf", None]
    assert values(spark, ["a.B.TXT", "none", None], "string", text.extension(v)) == [".txt", ".unknown", ".unknown"]
    assert values(spark, [0.0, 1536.0, 3 * 1024.0**3, None], "double", text.human_bytes(v)) == ["0.0 B", "1.5 KB", "3.0 GB", None]
    assert values(spark, ["a/b", "a@b"], "string", text.unslug(text.slug(v))) == ["a/b", "a@b"]
    assert values(spark, ["aGk_-w", "aGk"], "string", text.base64url(v)) == [bytearray(b"hi?\xfb"), bytearray(b"hi")]
    assert values(spark, ["12", "Wed, 21 Oct 2026 07:28:00 GMT", "x"], "string", text.retry_after(v, F.to_timestamp(F.lit("2026-10-21 07:27:00")))) == [12.0, 60.0, None]
    assert values(spark, [100, 0, None], "int", text.reset_wait(v, F.lit(90))) == [60, 60, 300]
    assert values(spark, ["<p class=\"x\" style='y'>a</p><style>.a{}</style>"], "string", text.chain(v, text.STYLE_CHAIN)) == ["<p>a</p>"]
    assert values(spark, ["acme Acme ACME"], "string", text.literal_chain(v, text.cased("acme", "bolt"))) == ["bolt Bolt BOLT"]


def test_spans_and_overlaps(spark):
    t = "Mail ann@corp.test or call +919876543210, card 4111 1111 1111 1111."
    found = {(s.kind, t[s.start : s.end]) for s in recognizers.resolve(recognizers.recognise(t), text=t)}
    assert ("EMAIL_ADDRESS", "ann@corp.test") in found and ("PHONE_NUMBER", "+919876543210") in found
    spans = [Span("A", 0, 5, 0.9), Span("B", 0, 8, 0.5), Span("C", 7, 9, 1.0), Span("D", 8, 9, 0.4)]
    assert [s.kind for s in recognizers.resolve(spans)] == ["B", "D"]
    assert [s.kind for s in recognizers.resolve(spans, frozenset(["abcdefgh"]), "abcdefghi")] == ["A", "C"]
    assert recognizers.splice("abcdef", [Span("A", 1, 3, 1), Span("B", 4, 5, 1)], ["<X>", "<Y>"]) == "a<X>d<Y>f"
    got = values(spark, [t, "", None, "ab"], "string", F.size(recognizers.spans(F.col("v"))))
    assert got[0] >= 3 and got[1:] == [0, 0, 0]
    assert values(spark, ["4111 1111 1111 1111 and 4111 1111 1111 1112"], "string", recognizers.luhn_cards(F.col("v"))) == [["4111111111111111"]]


def test_dictionary_spans_with_odd_letters():
    ahocorasick = pytest.importorskip("ahocorasick")
    a = ahocorasick.Automaton()
    for w in ("ann", "annabel", "bel lee"):
        a.add_word(w, ("PERSON", len(w)))
    a.make_automaton()
    t = "İ Annabel Lee"
    assert [t[s.start : s.end] for s in recognizers.dictionary_spans(t, a)] == ["Ann", "bel Lee"]
    assert [t[s.start : s.end] for s in recognizers.dictionary_spans(t, a, longest=True)] == ["Annabel"]
