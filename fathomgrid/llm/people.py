"""Matching person records of several sources that share no identifier.

Names are read from every attribute (display names, mail addresses, logins),
the sets of their letter pairs are encoded as fixed bit vectors, and all pairs
of distinct strings within a Hamming radius are found exactly by multi-index
hashing. Strings that are spelled with common name parts are anchors; others
(typing errors, joined or cut spellings) are tied to the one anchor that fits
them best by Dice score. What the attributes of a record say for an anchor is
its field-weighted Dice score, and the confidence of a tie is the rate at which
ties of its kind and score agree with the address of the same record. Records
that share an anchor by confident ties or a personal address are one person.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomgrid import storage

#: Three chunks of 64 bits; within radius 5 at least one chunk differs in no more than one bit.
CHUNKS, CHUNK_BITS, RADIUS = 3, 64, 5
#: A key under which more pairs than this would meet is split by a second chunk.
HOT = 1_000_000
#: A name part is common when this many records spell it so.
COMMON = 2
#: A spelling with a part this many times rarer than that of a near anchor is an error of it.
RARE = 10
#: An address is a shared mailbox when its records give more than two names and one in so many of the namings is not the most frequent name.
CONTRADICT = 8
#: Least confidence of a tie that joins a record to a person, and the confidence of an address that spells the name.
CONFIDENT, SPELLED = 0.5, 0.95
#: Weight of each attribute's Dice score in the score of a record and an anchor.
WEIGHTS = {"email": 3.0, "name": 2.5, "parts": 2.5, "slack_display_name": 2.0, "jira_display_name": 2.0, "github_login": 1.5, "slack_username": 1.5}

# Words of mailboxes and decorations that are no names, and the usual Latin letters of Cyrillic ones.
ROLES = frozenset("team desk farm call oncall support admin info noreply reply build release design ops office sales service security help root list group bot dev hr jobs press alerts ci mail hello contact billing data platform qa".split())
DECORATION = frozenset("bot dev hw qa ooo former contractor platform ext external admin mr mrs ms dr she her he him they them it ops".split())
CYRILLIC = dict(zip("абвгдезийклмнопрстуфыэ", "abvgdeziyklmnoprstufye")) | {"ж": "zh", "х": "h", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "sch", "ю": "yu", "я": "ya", "ё": "yo", "ъ": "", "ь": "", "і": "i", "ї": "yi", "є": "ye", "ґ": "g"}
LEET = str.maketrans("0134578", "oieastb")

_BRACKET = re.compile(r"\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")


def latin(text: str) -> str:
    """Latin letters of a text without accents, case kept; Cyrillic ones by their usual spelling."""
    out = []
    for c in text:
        low = c.lower()
        if low in CYRILLIC:
            t = CYRILLIC[low]
            out.append(t.capitalize() if c != low else t)
        else:
            out.append(c)
    return "".join(c for c in unicodedata.normalize("NFKD", "".join(out)) if not unicodedata.combining(c))


def sound(text: str) -> str:
    """Spelling folded to what survives a passage through another script."""
    t = text.lower()
    for a, b in (("qu", "kv"), ("ck", "k"), ("ph", "f"), ("th", "t"), ("w", "v"), ("j", "i"), ("y", "i"), ("c", "k"), ("q", "k"), ("x", "ks"), ("h", "")):
        t = t.replace(a, b)
    return re.sub(r"(.)\1", r"\1", t)


def _unleet(word: str) -> str:
    """Digits inside a word as the letters they stand for; digits at its end are numbers."""
    word = re.sub(r"\d+$", "", word)
    return word.translate(LEET) if re.search(r"\d", word) and re.search("[a-zA-Z]", word) else word


def name_parts(text: str | None) -> list[str]:
    """Lower-case parts of a written name, decoration removed; single letters kept, the part before a comma last."""
    if not text:
        return []
    text = latin(_BRACKET.sub(" ", text))
    if text.count(",") == 1:
        a, b = text.split(",")
        text = f"{b} {a}"
    words = [w for chunk in re.split(r"[^A-Za-z'’-]+", text) for w in re.split(r"(?<=\w)['’](?=\w)|['’]", chunk) if w]
    if len(words) == 1 and re.search("[a-z]", words[0]):
        words = [w for w in _CAMEL.split(words[0]) if w]
    return [w for w in (x.strip("-").lower() for x in words) if w and w not in DECORATION]


def login_parts(text: str | None) -> list[str]:
    """Lower-case parts of a login or of the local part of an address."""
    if not text:
        return []
    text = latin(text.split("+")[0])
    words = [w for chunk in re.split(r"[^A-Za-z0-9]+", text) for w in (_CAMEL.split(chunk) if not chunk.isupper() else [chunk]) if w]
    words = [_unleet(w.lower()) for w in words]
    return [w for w in words if w and not w.isdigit() and w not in DECORATION]


def address(email: str | None) -> tuple[str, str]:
    """Local part without tag, and the whole address, both lower case; empty for blank ones."""
    e = (email or "").strip().lower()
    local, at, domain = e.rpartition("@")
    return (local.split("+")[0], f"{local.split('+')[0]}@{domain}") if at and local else ("", "")


def is_role(email: str | None) -> bool:
    """Whether the words of an address name a function, not a person."""
    local, _ = address(email)
    return any(w in ROLES for w in re.split(r"[^a-z]+", local))


def readings(parts: list[str]) -> list[tuple[str, str]]:
    """Forms of a name's parts as (form, text).

    full: two parts in alphabetical order and a middle initial, `a b|i`; joined:
    one long part; cut: an initial with a part, `i b`. A double surname gives a
    full form for each half.
    """
    long = [p for p in parts if len(p.replace("-", "")) > 1]
    initials = [p for p in parts if len(p) == 1]
    if len(long) == 2:
        middle = initials[0] if initials else ""
        halves = [(a, b) for a in long[0].split("-") for b in long[1].split("-") if len(a) > 1 and len(b) > 1]
        return [("full", " ".join(sorted(h)) + "|" + middle) for h in halves]
    if len(long) > 2:
        return [("full", " ".join(sorted((long[0], long[-1]))) + "|")]
    if len(long) == 1 and initials:
        return [("cut", f"{initials[0]} {long[0]}")]
    if len(long) == 1 and len(long[0]) >= 5:
        return [("joined", long[0])]
    return []


def written(text: str | None) -> list[tuple[str, str]]:
    """Readings of a written name; one in another script reads as it sounds."""
    parts = name_parts(text)
    found = readings(parts)
    if text and any(c.lower() in CYRILLIC for c in text):
        return [("sound", spoken(t)) for f, t in found if f == "full"]
    return found


def spoken(full: str) -> str:
    """A full form as it sounds."""
    names, _, middle = full.partition("|")
    return " ".join(sorted(sound(p) for p in names.split(" "))) + "|" + middle


def features(text: str) -> set[int]:
    """Bits of a string: its unordered letter pairs, those within parts only."""
    found = set()
    for part in re.split(r"[ |]", text):
        for a, b in zip(part, part[1:]):
            found.add(xxhash.xxh32_intdigest(min(a, b) + max(a, b)) % (CHUNKS * CHUNK_BITS))
    return found


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _place(chunk: int, word: int) -> int:
    """A chunk and its word as one number; two that differ can share one, which the distance then tells apart."""
    return _signed((word ^ (0x9E3779B97F4A7C15 * (chunk + 1))) & (1 << 64) - 1)


def keys(bits: set[int], most: int = 1) -> list[tuple[int, int, int]]:
    """(chunk, key, gone) of every chunk with up to `most` of its set bits left out."""
    out = []
    for c in range(CHUNKS):
        own = [b - c * CHUNK_BITS for b in bits if c * CHUNK_BITS <= b < (c + 1) * CHUNK_BITS]
        word = sum(1 << b for b in own)
        for gone in range(most + 1):
            out += [(c, _signed(word ^ sum(1 << b for b in left)), gone) for left in combinations(own, gone)]
    return out


def edits(a: str, b: str, most: int = 2) -> int:
    """Edit distance with transpositions, most + 1 when above."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    last2: list[int] = []
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, last2[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        last2, last = last, row
    return last[-1]


def fit(form: str, text: str, anchor: str) -> tuple[str, float] | None:
    """How a string fits an anchor `a b|i`: the kind of fit and its Dice score; None when it does not."""
    names, _, middle = anchor.partition("|")
    a, _, b = names.partition(" ")
    x, y = features(text), features(names)
    dice = 2 * len(x & y) / max(1, len(x) + len(y))
    if form == "joined":
        whole = [a + b, b + a] if not middle else [a + middle + b, b + middle + a, a + b + middle, b + a + middle]
        if text in whole:
            return "joined", dice
        if middle:
            return None
        d = min(edits(text, w, 1) for w in whole)
        return ("joined typo", dice) if d <= 1 else None
    own, _, initial = text.partition("|")
    p, _, q = own.partition(" ")
    if initial and middle and initial != middle or bool(initial) != bool(middle):
        return None
    best = None
    for s, t in ((p, q), (q, p)):
        d1, d2 = edits(s, a, 1), edits(t, b, 1)
        if d1 + d2 <= 1:
            return "typo", dice
        for u, v, d in ((s, a, d2), (t, b, d1)):
            if d == 0 and 3 <= len(u) < len(v) and v.startswith(u):
                best = ("short", dice)
    return best


FIELDS = "rec_id long, source string, field string, form string, text string, address string, role boolean"
_COLUMNS = ["email", "name", "first_name", "last_name", "github_login", "slack_display_name", "slack_username", "jira_display_name"]


def views(people: DataFrame) -> DataFrame:
    """Readings of the names in all attributes of person records.

    people: rec_id, source and the attribute columns; missing attributes count
    as blank, extra ones are ignored. A record without any reading has none.
    Columns: rec_id, source, field, form, text; personal or shared address of
    the record in `address` on a row of its own with the form `address`.
    """

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = []
            for r in b.to_pylist():
                found: list[tuple[str, str, str]] = []
                local, whole = address(r["email"])
                role = is_role(r["email"])
                if local and not role:
                    found += [("email", *f) for f in readings(login_parts(local))]
                found += [("name", *f) for f in written(r["name"])]
                if (r["first_name"] or "").strip() and (r["last_name"] or "").strip():
                    found += [("parts", *f) for f in written(f"{r['first_name']} {r['last_name']}")]
                for field in ("slack_display_name", "jira_display_name"):
                    found += [(field, *f) for f in written(r[field])]
                for field in ("github_login", "slack_username"):
                    found += [(field, *f) for f in readings(login_parts(r[field]))]
                middles = {t.split("|")[0] for _, f, t in found if f == "full" and not t.endswith("|")}
                for field, form, text in dict.fromkeys(found):
                    if form == "full" and text.endswith("|") and text[:-1] in middles:
                        continue
                    rows.append((r["rec_id"], r["source"], field, form, text, None, role))
                if whole:
                    rows.append((r["rec_id"], r["source"], "email", "address", whole, whole, role))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_()))], names=["rec_id", "source", "field", "form", "text", "address", "role"])

    missing = [c for c in _COLUMNS if c not in people.columns]
    full = people.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else people
    return full.select(F.col("rec_id").cast("long").alias("rec_id"), F.col("source").cast("string").alias("source"), *_COLUMNS).where(F.col("rec_id").isNotNull()).mapInArrow(batches, FIELDS)


def near_pairs(strings: DataFrame) -> DataFrame:
    """Pairs (text, other) of distinct strings within the Hamming radius: exactly all, no other.

    strings: text, left and right flags; left ones are compared with right
    ones. By the pigeonhole principle a pair within radius 5 has a chunk of
    distance 0 or 1, so the chunks are equal or one of them is the other with
    one bit left out, and strings meet by such keys. A key where too many would
    meet is split: the other two chunks then differ in 5 bits at most, so one of
    them in no more than 2, and strings meet by both chunks. Words of the
    vectors travel along, so a pair is checked where it meets.
    """
    schema = "text string, lhs boolean, rhs boolean, w0 long, w1 long, w2 long, keys array<struct<key:long,gone:int>>"
    words = [f"w{i}" for i in range(CHUNKS)]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.list_(pa.struct([("key", pa.int64()), ("gone", pa.int32())]))
        for b in it:
            found, own = [], []
            for t in b.column(0).to_pylist():
                k = keys(features(t))
                own.append([v for _, v, g in k if not g])
                found.append([{"key": _place(c, v), "gone": g} for c, v, g in k])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *(pa.array([w[i] for w in own], pa.int64()) for i in range(CHUNKS)), pa.array(found, arrow)], names=["text", "lhs", "rhs", *words, "keys"])

    def finer(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows under split keys with the keys of the other chunks, up to two bits left out."""
        for b in it:
            at, second, gone2 = [], [], []
            key = b.column(b.schema.get_field_index("key")).to_pylist()
            for i, own in enumerate(zip(*(b.column(b.schema.get_field_index(w)).to_pylist() for w in words))):
                bits = {c * CHUNK_BITS + k for c, w in enumerate(own) for k in range(CHUNK_BITS) if w >> k & 1}
                all_keys = keys(bits, 2)
                first = {c for c, v, g in all_keys if g < 2 and _place(c, v) == key[i]}
                for c, v, g in all_keys:
                    if c not in first:
                        at.append(i)
                        second.append(_place(c, v))
                        gone2.append(g)
            rows = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(second, pa.int64()), pa.array(gone2, pa.int32())], names=[*b.schema.names, "key2", "gone2"])

    coded, coded_at = storage.materialise(storage.scatter(strings.select("text", "lhs", "rhs")).mapInArrow(batches, schema), "coded")
    flat = coded.select("text", "lhs", "rhs", *words, F.explode("keys").alias("k")).select("text", "lhs", "rhs", *words, "k.*")
    hot = flat.groupBy("key").agg((F.count_if("lhs") * F.count_if("rhs")).alias("pairs")).where(F.col("pairs") > HOT).select("key")
    hot, hot_at = storage.materialise(hot, "hot")
    distance = sum((F.bit_count(F.col(f"{w}a").bitwiseXOR(F.col(f"{w}b"))) for w in words), F.lit(0))
    near = ((F.col("ga") == 0) | (F.col("gb") == 0)) & (F.col("text") != F.col("other")) & (distance <= RADIUS)

    def sides(rows: DataFrame, on: list[str]) -> DataFrame:
        second = on[1:]
        more = lambda s: [F.col("gone2").alias(f"gone2{s}")] if second else []
        a = rows.where("lhs").select(*on, F.col("gone").alias("ga"), "text", *[F.col(w).alias(f"{w}a") for w in words], *more("a"))
        b = rows.where("rhs").select(*on, F.col("gone").alias("gb"), F.col("text").alias("other"), *[F.col(w).alias(f"{w}b") for w in words], *more("b"))
        return a.join(b, on).where(near & (F.col("gone2a") + F.col("gone2b") <= 2) if second else near).select("text", "other")

    if hot.isEmpty():
        found = sides(flat, ["key"])
    else:
        split = flat.join(hot, "key", "left_semi").select("text", "lhs", "rhs", *words, "key", "gone").mapInArrow(finer, "text string, lhs boolean, rhs boolean, w0 long, w1 long, w2 long, key long, gone int, key2 long, gone2 int")
        found = sides(flat.join(hot, "key", "left_anti"), ["key"]).unionByName(sides(split, ["key", "key2"]))
    pairs, _ = storage.materialise(found.distinct(), "near")
    storage.remove(strings.sparkSession, coded_at)
    storage.remove(strings.sparkSession, hot_at)
    return pairs


def _anchored(strings: DataFrame) -> DataFrame:
    """The anchor of each full or joined string: text, form, anchor, kind, dice.

    strings: form, text, support. Full strings of common parts are their own
    anchors unless they are a far rarer spelling of a near one. Others go to the one anchor that fits best; where two fit alike
    they stay alone, a full string then as its own anchor.
    """
    full = strings.where("form = 'full'")
    parts = full.select("text", "support", F.explode(F.split(F.split_part("text", F.lit("|"), F.lit(1)), " ")).alias("part"))
    spelled = parts.groupBy("part").agg(F.sum("support").alias("n"))
    least = parts.join(spelled, "part").groupBy("text").agg(F.min("n").alias("n"), F.min(F.length("part")).alias("size"))
    solid = (F.col("n") >= COMMON) & (F.col("size") > 3) & (F.col("form") == "full")
    known = strings.join(least, "text", "left").select("form", "text", "support", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce(solid, F.lit(False)).alias("solid"))
    known, _ = storage.materialise(known, "strings")
    pairs = near_pairs(known.groupBy("text").agg(F.lit(True).alias("lhs"), F.max("solid").alias("rhs")))
    left = known.select("form", "text", F.col("n").alias("own"), F.col("solid").alias("own_solid"))
    right = known.where("solid").select(F.col("text").alias("other"), F.col("support").alias("weight"), "n")
    offered = pairs.join(left, "text").join(right, "other").where(~F.col("own_solid") | (F.col("own") * RARE <= F.col("n")))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = [(f, t, o, w, *g) for f, t, o, w in zip(*(b.column(i).to_pylist() for i in range(4))) if (g := fit(f, t, o))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.float64()))], names=["form", "text", "anchor", "weight", "kind", "dice"])

    fits = storage.scatter(offered.select("form", "text", "other", F.col("weight").cast("long").alias("weight"))).mapInArrow(batches, "form string, text string, anchor string, weight long, kind string, dice double")
    rank = F.when(F.col("kind") == "joined", 3).when(F.col("kind").isin("typo", "joined typo"), 2).otherwise(1)
    best = fits.groupBy("form", "text").agg(F.max(F.struct(rank.alias("r"), "dice", "kind", "anchor")).alias("best"), F.collect_list(F.struct(rank.alias("r"), "anchor")).alias("all"))
    alone = F.size(F.array_distinct(F.transform(F.filter("all", lambda x: x["r"] == F.col("best")["r"]), lambda x: x["anchor"]))) == 1
    chosen = best.where(alone & ((F.col("best.kind") != "short") | (F.col("form") == "full"))).select("form", "text", "best.anchor", "best.kind", "best.dice")
    rare = chosen.where("kind = 'typo'").select("form", "text").withColumn("rare", F.lit(True))
    known = known.join(rare, ["form", "text"], "left").withColumn("solid", F.col("solid") & F.col("rare").isNull())
    rest = known.join(chosen.select("form", "text", "anchor", "kind", "dice"), ["form", "text"], "left")
    return rest.select(
        "form", "text",
        F.when(F.col("solid"), F.col("text")).when(F.col("anchor").isNotNull(), F.col("anchor")).when(F.col("form") == "full", F.col("text")).alias("anchor"),
        F.when(F.col("solid"), "same").when(F.col("anchor").isNotNull(), F.col("kind")).otherwise("own").alias("kind"), F.coalesce(F.when(~F.col("solid"), F.col("dice")), F.lit(1.0)).alias("dice"),
    ).where(F.col("anchor").isNotNull())


def _aliases(anchor: str) -> list[tuple[str, str]]:
    """Cut spellings of an anchor's name in both orders, and how it sounds."""
    names = anchor.split("|")[0].split(" ")
    if len(names) != 2:
        return []
    a, b = names
    out = [("sound", spoken(anchor))]
    for p, q in ((a, b), (b, a)):
        out += [("cut", f"{p[0]} {q}"), ("joined", p[0] + q), ("joined", p + q[0]), ("joined", p[:3] + q[:4]), ("joined", p[:3] + q[:3]), ("short", f"{p[:3]} {q}")]
    return list(dict.fromkeys(out))


def _components(edges: DataFrame) -> tuple[DataFrame, list[str]]:
    """Smallest node of the component of every node of an undirected graph: node, root; and the paths to remove once it is read.

    Each round takes over the smallest root among the neighbours and then that
    root's own root, so labels jump in growing steps. Rounds end when no label
    changes.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both, both_at = storage.materialise(both, "edges")
    state, state_at = storage.materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).select(F.col("a").alias("node"), "root"), "roots")
    old: list[str] = [state_at]
    while True:
        offered = both.join(state.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("low"))
        lower = state.join(offered, "node").select("node", "root", F.least("root", "low").alias("low"))
        jump = state.select(F.col("node").alias("low"), F.col("root").alias("far"))
        new, at, changed = storage.materialise_counted(lower.join(jump, "low").select("node", F.least("low", "far").alias("root"), F.col("root").alias("was")), "roots", F.col("root") != F.col("was"))
        state = new.select("node", "root")
        old.append(at)
        if len(old) > 2:
            storage.remove(state.sparkSession, old.pop(0))
        if not changed:
            storage.remove(state.sparkSession, both_at)
            return state, old


def _weighed(told: DataFrame) -> DataFrame:
    """Field-weighted Dice scores of records and anchors.

    told: rec_id, source, votes (field, anchor, kind, dice). The score of an
    anchor is the weighted sum of the Dice scores of the attributes that give
    it, over the weights of all attributes of the record that give any anchor.
    `score` and `kind` leave the address out, which `mail` tells (whether it gives this
    anchor) and `mail_anchor` (the anchor it gives, if any by its spelling).
    """
    weight = F.create_map(*[x for f, w in WEIGHTS.items() for x in (F.lit(f), F.lit(w))])

    def total(fields: Column) -> Column:
        return F.aggregate(F.array_distinct(fields), F.lit(0.0), lambda a, f: a + F.coalesce(weight[f], F.lit(1.0)))

    def anchor_score(a: Column) -> Column:
        own = F.filter("others", lambda v: v["anchor"] == a)
        given = F.aggregate(own, F.lit(0.0), lambda s, v: s + F.coalesce(weight[v["field"]], F.lit(1.0)) * v["dice"])
        rank = lambda v: F.when(v["kind"] == "same", 5).when(v["kind"] == "joined", 4).when(v["kind"].isin("typo", "joined typo"), 3).when(v["kind"].isin("sound", "own"), 2).otherwise(1)
        by = F.when(F.size(own) > 0, own).otherwise(F.filter("votes", lambda v: v["anchor"] == a))
        best = F.array_max(F.transform(by, lambda v: F.struct(rank(v).alias("r"), v["kind"].alias("kind"))))
        return F.struct(a.alias("anchor"), best["kind"].alias("kind"), F.when(F.size(own) > 0, F.least(F.lit(1.0), given / F.col("all"))).alias("score"), F.exists("votes", lambda v: (v["anchor"] == a) & (v["field"] == "email")).alias("mail"))

    spelled = F.filter("votes", lambda v: (v["field"] == "email") & v["kind"].isin("same", "own", "joined"))
    rows = told.select("rec_id", "source", "votes", F.filter("votes", lambda v: v["field"] != "email").alias("others"), F.array_min(F.transform(spelled, lambda v: v["anchor"])).alias("mail_anchor"))
    rows = rows.withColumn("all", total(F.col("others.field")))
    return rows.select("rec_id", "source", "mail_anchor", F.explode(F.transform(F.array_distinct("votes.anchor"), anchor_score)).alias("t")).select("rec_id", "source", "mail_anchor", "t.*")


def _confident(scores: DataFrame) -> DataFrame:
    """Ties with their calibrated confidence: rec_id, source, anchor, confidence.

    The rate at which anchors of a kind and score are the one that the address
    of the same record spells is the confidence of that kind and score; where
    too few addresses tell, a prior has the weight of two. An address that
    spells the anchor itself is a second witness.
    """
    bucket = F.floor(F.col("score") * 10)
    prior = F.when(F.col("kind").isin("same", "joined"), 0.95).when(F.col("kind") == "cut", 0.6).otherwise(0.8)
    keyed = scores.withColumn("bucket", bucket).withColumn("prior", prior)
    rates = keyed.where("mail_anchor is not null and bucket is not null").groupBy("kind", "bucket").agg(F.count_if(F.col("anchor") == F.col("mail_anchor")).alias("right"), F.count(F.lit(1)).alias("n"))
    rated = keyed.join(rates, ["kind", "bucket"], "left")
    by_names = (F.coalesce("right", F.lit(0)) + 2 * F.col("prior")) / (F.coalesce("n", F.lit(0)) + 2)
    doubt = F.when(F.col("score").isNotNull(), 1 - by_names).otherwise(F.lit(1.0)) * F.when(F.col("mail"), 1 - F.lit(SPELLED)).otherwise(F.lit(1.0))
    return rated.select("rec_id", "source", "anchor", (1 - doubt).alias("confidence"))


def match(people: DataFrame) -> DataFrame:
    """Persons of records: rec_id, source, person and the confidence of the record's tie to the person.

    people: rec_id, source (the table it comes from) and any of the attributes
    email, name, first_name, last_name, github_login, slack_display_name,
    slack_username, jira_display_name. Blank attributes say nothing. A record
    that can be tied to no other is a person of its own with confidence 1.
    Repeated records fall together; an empty table gives none. person is the
    smallest record id of the person as text.
    """
    spark = people.sparkSession
    seen, seen_at = storage.materialise(views(people).distinct(), "views")
    named = seen.where("form <> 'address'")
    strings = named.where("form in ('full', 'joined')").groupBy("form", "text").agg(F.countDistinct("rec_id").alias("support"))

    # one spelling of a middle initial takes over the spelling without one
    names = F.split_part("anchor", F.lit("|"), F.lit(1))
    with_middle = F.collect_set(F.when(~F.col("anchor").endswith("|"), F.col("anchor"))).over(Window.partitionBy("names"))
    anchors = _anchored(strings).withColumn("names", names).withColumn("middles", with_middle)
    anchors = anchors.select("form", "text", F.when(F.col("anchor").endswith("|") & (F.size("middles") == 1), F.col("middles")[0]).otherwise(F.col("anchor")).alias("anchor"), "kind", "dice")
    anchors, anchors_at = storage.materialise(anchors, "anchors")

    # other spellings that only one anchor has
    def aliases(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = [(*x, a) for a in b.column(0).to_pylist() for x in _aliases(a)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["way", "alias", "anchor"])

    solid = anchors.where("kind in ('same', 'own') and form = 'full'").select("anchor").distinct()
    unique = solid.mapInArrow(aliases, "way string, alias string, anchor string").groupBy("way", "alias").agg(F.min("anchor").alias("anchor"), F.max("anchor").alias("other"))
    unique, unique_at = storage.materialise(unique.where("anchor = other").select("way", "alias", "anchor"), "aliases")

    tied = named.join(anchors, ["form", "text"]).select("rec_id", "source", "field", "anchor", "kind", "dice")
    heard = named.where("form = 'sound'").join(unique.where("way = 'sound'").select(F.col("alias").alias("text"), "anchor"), "text", "left")
    heard = heard.select("rec_id", "source", "field", F.coalesce("anchor", F.concat(F.lit("sound "), "text")).alias("anchor"), F.lit("sound").alias("kind"), F.lit(0.8).alias("dice"))
    votes = F.collect_set(F.struct("field", "anchor", "kind", "dice"))
    told = tied.unionByName(heard).groupBy("rec_id", "source").agg(votes.alias("votes"))
    # a short or odd form says nothing where another attribute spells the name out
    spelled = F.exists("votes", lambda v: v["kind"].isin("same", "joined"))
    told = told.withColumn("votes", F.when(spelled, F.filter("votes", lambda v: ~v["kind"].isin("short", "own"))).otherwise(F.col("votes")))
    told, told_at = storage.materialise(told, "told")

    loose = named.join(told.select("rec_id"), "rec_id", "left_anti").select("rec_id", "source", "field", "form", "text")
    cut = loose.join(unique.select(F.col("way").alias("form"), F.col("alias").alias("text"), "anchor"), ["form", "text"])
    agreed = cut.groupBy("rec_id", "source").agg(F.min("anchor").alias("anchor"), F.max("anchor").alias("other"), F.max("field").alias("field")).where("anchor = other")
    every = told.unionByName(agreed.select("rec_id", "source", F.array(F.struct("field", "anchor", F.lit("cut").alias("kind"), F.lit(0.5).alias("dice"))).alias("votes")))
    ties, ties_at = storage.materialise(_confident(_weighed(every)), "ties")

    # a personal address: of any number of records, whose names do not contradict
    mails = seen.where("form = 'address' and not role").select("rec_id", F.col("text").alias("mail"))
    said = mails.distinct().join(told.select("rec_id", F.explode("votes.anchor").alias("anchor")).distinct(), "rec_id", "left")
    by_name = said.groupBy("mail", "anchor").agg(F.count(F.lit(1)).alias("n"), F.min("rec_id").alias("low"), F.max("rec_id").alias("high"))
    named = F.col("anchor").isNotNull()
    use = by_name.groupBy("mail").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count("anchor").alias("names"), F.sum(F.when(named, F.col("n"))).alias("said"), F.max(F.when(named, F.col("n"))).alias("most"))
    agree = (F.col("names") <= 2) | ((F.col("said") - F.col("most")) * CONTRADICT < F.col("said"))
    personal = mails.join(use.where((F.col("low") < F.col("high")) & agree).select("mail"), "mail")

    node = F.concat(F.lit("r"), F.format_string("%020d", "rec_id"))
    edges = ties.where(F.col("confidence") >= CONFIDENT).select(node.alias("a"), F.concat(F.lit("s"), "anchor").alias("b")).unionByName(personal.select(node.alias("a"), F.concat(F.lit("m"), "mail").alias("b")))
    roots, roots_at = _components(edges)
    roots = roots.where(F.col("node").startswith("r")).select(F.substring("node", 2, 20).cast("long").alias("rec_id"), F.col("root").alias("person"))
    sure = ties.groupBy("rec_id").agg(F.max("confidence").alias("confidence"))
    records = people.select(F.col("rec_id").cast("long").alias("rec_id"), F.col("source").cast("string").alias("source")).where(F.col("rec_id").isNotNull()).distinct()
    persons = records.join(roots, "rec_id", "left").join(sure, "rec_id", "left").select(
        "rec_id", "source", F.coalesce("person", node).alias("person"), F.coalesce("confidence", F.lit(1.0)).alias("confidence")
    )
    persons, _ = storage.materialise(persons, "persons")
    for path in (seen_at, anchors_at, unique_at, told_at, ties_at, *roots_at):
        storage.remove(spark, path)
    return persons


def pairs(persons: DataFrame) -> DataFrame:
    """Pairs of records of one person from different sources: rec_id_a < rec_id_b with a confidence.

    The confidence of a pair is that both ties hold. A person has as many pairs
    as the result asks for.
    """
    a = persons.select("person", F.col("rec_id").alias("rec_id_a"), F.col("source").alias("sa"), F.col("confidence").alias("ca"))
    b = persons.select("person", F.col("rec_id").alias("rec_id_b"), F.col("source").alias("sb"), F.col("confidence").alias("cb"))
    return a.join(b, "person").where("rec_id_a < rec_id_b and sa <> sb").select("rec_id_a", "rec_id_b", (F.col("ca") * F.col("cb")).alias("confidence"))
