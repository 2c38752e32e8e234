"""Personal data in free text: a linear-chain conditional random field over word shapes.

Texts are cut into tokens; each token has attributes (shape, affixes, context
words) and every attribute of the token and its neighbours scores the labels.
Weights are trained on a labelled table of sentence patterns with drawn values.
Decoding is Viterbi over many sentences at once in numpy. A short check of the
form of each value follows; values then become typed placeholders.
"""

from __future__ import annotations

import copy
import random
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomgrid import storage

KINDS = ("email", "phone", "id_number", "address", "person_name")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
#: Drawn sentences in the training table, passes over it, and the seed of the draw.
SENTENCES, EPOCHS, SEED = 3600, 9, 29
#: Neighbours whose attributes count.
OFFSETS = (-3, -2, -1, 0, 1, 2, 3)
#: Lines and padded tokens of a batch in decoding; a longer line is a batch of its own.
LINES, PADDED = 256, 60_000
#: A word is common when it makes up this share of all words and occurs this often; so there are never more than the inverse of the share.
SHARE, OFTEN = 1 / 40_000, 5
#: A common word is the word of a name when it is decoded as part of one in this share of its occurrences.
NAMED = 0.2

_AT = r"(?:@|＠|%40|&#64;|\(at\)|\[at\])"
_REST = r"|[+]?\d+(?:[.\-–]\d+)+|[+]\d+|\d+[^\W\d_]?(?=[^\w]|$)|[^\W_]+(?:[-’](?=\w)[^\W_]+|_[^\W_]+)*(?:['’](?=s\b))?|\n+|[^\w\s]|_+"
#: A local part begins where no other could, so that a long run without address is tried once.
_TOKEN = re.compile(rf"https?://[^\s<>\"']+|(?<![\w%+-])(?<![\w%+-]\.)(?:[\w%+-]|\.(?=\w))+{_AT}\w(?:[\w-]|\.(?=\w))*(?::[\w./~-]+)?|@[\w-]+/[\w.-]+" + _REST)
#: The same for texts without any sign of a mail address.
_PLAIN = re.compile(r"https?://[^\s<>\"']+" + _REST)
_BREAK = re.compile(r"\n")
_PART = re.compile(r"[^\W\d_]{2,}")

# Words of which addresses are made.
_STREET = frozenset("street st road rd avenue ave lane ln drive dr boulevard blvd way court ct place pl square sq terrace close crescent quay row rue calle avenida camino plaza via strasse straße str weg gasse allee platz chaussée chemin impasse ulitsa улица ул проспект пр переулок".split())
_UNIT = frozenset("flat apt apartment suite unit floor po box".split())


def shape(word: str) -> str:
    """Letters as x or X, digits as d, runs shortened; other characters as they are."""
    out = []
    for c in word[:40]:
        if c.isdigit():
            s = "d"
        elif c.isalpha():
            s = "X" if c.isupper() else "x"
        else:
            s = c
        if len(out) < 2 or s != out[-1] or s != out[-2]:
            out.append(s)
    return "".join(out)


def _case(word: str) -> str:
    letters = [c for c in word if c.isalpha()]
    if not letters:
        return "none"
    if all(c.islower() for c in letters):
        return "lower"
    if letters[0].isupper() and all(c.islower() for c in letters[1:]):
        return "title"
    if all(c.isupper() for c in letters):
        return "upper1" if len(letters) == 1 else "upper"
    return "title" if letters[0].isupper() else "mixed"


def attributes(word: str, vocabulary: frozenset[str], common: frozenset[str]) -> list[str]:
    """Attributes of a token: its shape, case, length, script, whether it is a common word, and itself if it is a word of the patterns."""
    if word[0] == "\n":
        return ["newline"]
    low = word.lower().rstrip("'’")
    case = _case(word)
    often = "often" if low in common or low in vocabulary else "seldom"
    out = [often, f"{often}:{case}"]
    if low in vocabulary:
        out += ["w:" + low, "known:" + case]
    digits = sum(c.isdigit() for c in word)
    out += ["s:" + shape(word), "c:" + case]
    if digits:
        out.append("nd:" + str(min(digits, 12)))
        if digits == len(word):
            out.append("digits:" + str(min(digits, 10)))
        elif word[-1].isalpha() and word[:-1].isdigit():
            out.append("number+letter")
    elif word.isalpha() or case != "none":
        out += ["n:" + str(min(len(word), 12)), f"c:{case}:{'long' if len(word) > 3 else 'short' if len(word) > 1 else 'one'}"]
        if "-" in word:
            out.append("hyphen:" + case)
        if not word.isascii():
            name = unicodedata.name(next((c for c in word if ord(c) > 127), "a"), "")
            out.append("script:" + name.split(" ")[0])
        if low in _STREET:
            out.append("street")
        elif any(low.endswith(x) for x in ("straße", "strasse", "street", "weg", "gasse", "allee")) and len(low) > 7:
            out.append("street+")
        if low in _UNIT:
            out.append("unit")
        if "-" in word:
            out.append("parts:" + ("often" if any(p in common for p in low.split("-")) else "seldom"))
    else:
        out.append("p:" + word)
    if re.search(_AT, word) and len(word) > 2:
        local, _, domain = re.sub(_AT, "@", word).rpartition("@")
        out.append("mail" if local and "." in domain and ":" not in domain and "/" not in word else "remote")
    if word.startswith("http"):
        out.append("url")
    return out


# The parts of which drawn names, places and addresses are made.
_ON = "B Br Ch D Dr F Fr G Gr H J K Kr L M N P Pr R S Sh T Tr V W Y Z El Or An Il Ol".split()
_MID = "a e i o u ai ei ia".split()
_END = "n r l s m ra na la ro ni ca lia mir vin zef bel ten dak ris ton nor ster wick ford sen ov ic etti ano berg quist mar roth".split()
_PLACES = "Millbrook Stonehaven Eastport Ridgeway Oakdale Norfield Lakemont Westbury Harrow Fairview Seaview Kingsbay".split()
_ROADS = "Maple Cedar Station Church Mill Park Hill Bridge Chestnut Willow Castle Market Garden Poplar North Elm".split()
_CYR = dict(zip("abcdefghijklmnopqrstuvwxyz", "абкдефгхийклмнопкрстувексз")) | {"y": "й", "w": "в"}
_HOSTS = "example.com mailbox.test corp.example post.invalid mail.office.example my-firm.example".split()


class _Draw:
    """Draws values of each kind."""

    def __init__(self, r: random.Random):
        self.r = r

    def word(self, least: int, most: int) -> str:
        r = self.r
        return "".join(r.choice(_ON) + r.choice(_MID) for _ in range(r.randint(least, most))).lower().capitalize() + r.choice(_END)

    def name(self) -> str:
        r = self.r
        first, last = self.word(1, 2), self.word(1, 3)
        if r.random() < 0.08:
            last += "-" + self.word(1, 2)
        form = r.random()
        if form < 0.38:
            name = f"{first} {last}"
        elif form < 0.50:
            name = f"{first} {r.choice('ABCDEFGHJKLMNPRSTVWZ')}. {last}"
        elif form < 0.62:
            name = f"{r.choice('ABCDEFGHJKLMNOPRSTVWYZ')}. {last}"
        elif form < 0.74:
            name = f"{last}, {first}"
        elif form < 0.83:
            name = f"{first} {last.upper()}"
        else:
            name = f"{first} {last}"
        style = r.random()
        if style < 0.12:
            name = name.lower()
        elif style < 0.22:
            name = "".join((_CYR.get(c.lower(), c).upper() if c.isupper() else _CYR.get(c, c)) for c in name)
        elif style < 0.30:
            name = name.translate(str.maketrans("aeiou", "áéíöü"))
        elif style < 0.34:
            name = name.upper()
        return name

    def email(self) -> str:
        r = self.r
        first, last = self.word(1, 2).lower(), self.word(1, 2).lower()
        local = r.choice([f"{first}.{last}", f"{first}_{last}", f"{last}-{first}+jira", f"{first[0]}{last}", f"{first}{r.randint(1, 99)}", f"{first}.{last}{r.randint(1, 99)}", first + last, f"{first}-{last}"])
        host = r.choice(_HOSTS)
        if r.random() < 0.15:
            local, host = local.upper(), host.upper()
        way = r.random()
        if way < 0.55:
            return f"{local}@{host}"
        return r.choice([f"{local}(at){host}", f"{local} @ {host}", f"{local}＠{host}", f"{local}%40{host}", local + " [at] " + host.replace(".", " [dot] "), local + " (at) " + host.replace(".", " (dot) "), local + " at " + host.replace(".", " dot ")])

    def phone(self) -> str:
        r = self.r
        d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
        p = r.choice([f"{d(3)}-{d(3)}-{d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"+1 ({d(3)}) {d(3)}-{d(4)}", f"+1.{d(3)}.{d(3)}.{d(4)}", f"+44 {d(4)} {d(6)}", f"0{d(4)} {d(3)} {d(3)}", f"+{d(3)} {d(2)} {d(3)} {d(2)} {d(2)}", f"00{d(11)}", f"({d(3)}) {d(3)} {d(4)} ext. {d(2)}", f"+49 {d(3)} {d(7)}", f"+{d(11)}", f"0{d(2)} {d(4)} {d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"+33 {d(1)} {d(2)} {d(2)} {d(2)} {d(2)}"])
        return p.translate(str.maketrans("0123456789", "０１２３４５６７８９")) if r.random() < 0.15 else p

    def id_number(self) -> str:
        r = self.r
        d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
        u = lambda n: "".join(r.choice("ABCDEFGHKLMNPQRSTXYZ") for _ in range(n))
        return r.choice([f"{d(3)}-{d(2)}-{d(4)}", f"{d(3)} {d(2)} {d(4)}", f"{u(2)} {d(2)} {d(2)} {d(2)} {u(1)}", f"{u(1)}{d(8)}", f"{d(6)}-{d(4)}-{u(1)}", f"{u(2)}{d(2)} {d(4)} {d(4)} {d(4)} {d(2)}", f"{u(2)}{d(7)}", f"{d(8)}{u(1)}", f"{u(2)}{d(6)}{u(1)}"])

    def address(self) -> str:
        r = self.r
        n, road, place, zip5 = r.randint(1, 320), r.choice(_ROADS), r.choice(_PLACES), r.randint(10000, 99999)
        if r.random() < 0.15:
            place = r.choice(("Port ", "Saint ", "New ")) + place
        if r.random() < 0.25:
            road = "Old " + road
        kind = r.choice(["Street", "Road", "Lane", "Avenue", "Drive"])
        a = r.choice([f"{n} {road} {kind}, {place}", f"{n} {road} {kind}, {place}", f"{n}{r.choice('ABC')} {road} {r.choice(['St.', 'Rd', 'Ave', 'St'])}, {place} {zip5}", f"Flat {n % 40 + 1}, {n} {road} {kind}, {place}", f"{road}straße {n}, {zip5} {place}", f"{road}weg {n}, {zip5} {place}", f"Calle {road} {n}, {place}", f"{n} rue {road}, {zip5} {place}", f"{n} {road.lower()} {kind.lower()}, {place.lower()}", f"ул. {road} {n}, {place}"])
        return a.lower() if r.random() < 0.06 else a

    def plain(self) -> str:
        """What looks like personal data and is none."""
        r = self.r
        n = r.randint(1, 99)
        return r.choice([
            f"Host 10.0.{n}.7 answered in {n}.5 ms", f"Build 2024-0{n}-{n} passed on agent {n}", f"Order number {n}0-200-{n}000 is a sample", f"Request id {n}f1e{n}-77aa-4b{n} timed out", f"Version 5{n}.01{n}.2 and port 8{n}0 are open", f"Ticket OPSX-55{n}01{n} blocks {r.choice(_ROADS)} {r.choice(_ROADS)}",
            f"Tracking code 1Z-{n}-{n}-8812 is internal", f"Time stamp 2025-03-{n % 28 + 1:02d} 11:00 and epoch 1700{n}0000 differ", f"Remote is git@code.corp.example:team/{r.choice(_ROADS).lower()}-app.git here", f"Use the @Override marker and @{r.choice(_ROADS).lower()}/core 2.{n}.1", f"Ping @release-team about {r.choice(_ROADS)} {r.choice(['Auth', 'Gate', 'Relay', 'Ledger', 'Index'])} and {r.choice(_ROADS)} {r.choice(['Gate', 'Sync', 'Scheduler'])}",
            f"{r.choice(_ROADS)} Relay and {r.choice(_ROADS)} Ledger share one queue", f"{r.choice(['Port', 'New', 'Saint'])} {r.choice(_PLACES)} and {r.choice(_PLACES)} share one proxy", f"The {r.choice(_PLACES)} office lost power at 09:{n}:30", f"See PROJ-{n} and commit 4f{n}c0ffee{n}", f"See https://wiki.corp.example/page?id={n}.html for details", f"Cost rose from ${n} to $9 per seat", f"Range 5 < x < {n} is fine", f"Line -{n} is odd, and #{n} too",
            f"We measured {n}.14 seconds in v2.{n}.1", f"Release 2.{n}.0-rc.1 ships on 03.04., not earlier", f"Am 3. April um 9.30 Uhr startet Version 1.{n}.0", f"Fig. {n} shows the gap; cf. sec. 4.2 of the report", f"Step No. {n} of the checklist was skipped", f"Siehe Abb. {n} bzw. Kap. 4.2 im Bericht", f"Ask Dr. {self.word(1, 2)} or the team lead at {n % 12} a.m. on Monday", f"La Sra. {self.word(1, 2)} llega a las 9.30 a. m. del lunes", f"Invoice {n}{n}{n} of 2025 is late",
            f"{self.word(1, 2)} said yes", f"It cost approx. {n}.50 credits", f"1. {self.word(1, 1).lower()} first", f"Tools by {r.choice(_ROADS)} {r.choice(_ROADS)} Inc. cost {n} more than in Q{n % 4 + 1}", f"El {r.choice(_PLACES)} está en la página {n}", f"Path \\\\files\\share\\{n} is gone", f"{{code}} f({n}); {{code}}", f"SELECT key FROM t WHERE n > {n};", f"Node.js and the ASP.NET bridge differ", f"Der {r.choice(_ROADS)} {r.choice(_PLACES)} Dienst läuft auf Port {n}", f"The {r.choice(_ROADS)} {r.choice(_ROADS)} project ends", f"for k in keys: print({n})",
        ])


#: The labelled table: patterns in which {N} is a name, {E} an address of mail, {P} a phone, {I} an identity number, {A} a postal address; {O} is none of them.
_PATTERNS = """
Contact: {N} / {E} (on leave).|Contact: {N} / {P} (on leave).|From: {N} <{E}> today.|Cc: {E}, on-call list|Reply went to {E} by mistake.|Bitte an {E} weiterleiten.|Merci d'écrire à {E} avant midi.|Escribir a {E} si falla.|Please send the log to {E} before Friday.|Login as <{E}> still fails.
The account {E} was locked twice.|mailto:{E} opens a blank page.|user="{E}" was rejected|Mail {E} or ask here.|Пишите на {E} сегодня.|Remove {E} from the list|Request from {E} about labels|Complaint ({E}) on the old pages
Call {P} if the job stops.|Text {P} or ring twice.|tel: {P} (mobile)|callback={P}&retry=1|Llamar al {P} por favor.|Rückruf unter {P} erbeten.|Appelez le {P} demain.|Звоните по номеру {P} утром.|Request from {P} about labels|Complaint ({P}) on the old pages|Remove {P} from the list|Her number is {P} for now.|Fax {P}, phone {P}.|The agent can be reached on {P} after lunch.|Hotline number is {P} for now.|Dial {P} now.
National id {I} appears in the export.|The form shows passport {I} in clear text.|Tax number {I} was pasted into the field.|Insured under no. {I} since May.|Ausweis {I} steht im Protokoll.|SSN {I} leaked.|Numéro de sécurité {I} visible.|El DNI {I} aparece aquí.|Паспорт {I} указан в файле.|Request from {I} about labels|Complaint ({I}) on the old pages|Remove {I} from the list|Steuernummer {I} fehlt.|Policy {I} of the insurance is shown.
Ship to {N}, {A} (gate 2).|Site visit planned at {A} on Tuesday.|Delivery address is {A} for this order.|The badge was shipped to {A} last week.|Bitte an {A} liefern.|Livrer à {A} demain.|Entregar en {A} hoy.|Доставить: {A} завтра.|Remove {A} from the list|Request from {A} about labels|Complaint ({A}) on the old pages|They moved to {A} in June.|My address: {A}
{N}'s laptop was replaced twice.|Please ping Mx. {N} again.|Please ping {N} again.|Bitte Frau {N} fragen.|Bitte Herrn {N} fragen.|Merci de prévenir {N} demain.|As discussed with {N} the fix can wait.|Spoke with {N} about the rollback.|Laut {N} ist das bekannt.|"{N}" was typed into the title field.|Attendees were {N} and two guests.|Reported by {N} during the demo.|Access for {N} must be removed.|Waiting for {N} to sign off.|Present: {N}; {N} and {N} as well.
{N} confirmed the workaround.|cc @{N}, see above|Thanks to @{N} for the hint.|cc {N} - done?|fyi {N} please|fyi @{N})|Assigned: @{N}, see above|(@{N} please|Thanks to {N})|Assigned: {N} for the hint.|(@{N}, see above)|owner={N} state=open|Remove {N} from the list|Request from {N} about labels|Complaint ({N}) on the old pages|Signed, {N}|Avisar a {N} mañana.|Спросите у {N} завтра.|{N} wrote: the page is gone.|Author: {N}|Reviewed-by: {N} <{E}>|{N} and {N} agree.|Ask {N} or {N}.|According to {N}, it works.|El usuario {N} no puede entrar.|Je transmets à {N} ce soir.|Gespräch mit {N} am Montag.
"""

_FILLER = """
The report shows the old values after a restart.|The server drops the new page whenever the network fails, so the cache rejects two labels.|A slow job hides the list for guest accounts.|Our team checks the table with more than ten replies.|Please open the file, e.g. the block on line 5, and compare it.|Is the queue down?|Really?!|Wait... the second job is still running.|Der Dienst verwirft die Seite nach einem Neustart.|Die Liste zeigt alte Werte ohne Warnung, aber das Feld bleibt leer.|Das Archiv sperrt den Verweis am Monatsende.|Le service perd la page depuis la mise à jour.|La file garde le lien sous forte charge, et le cache bloque la date.|El servicio pierde la fecha sin aviso, pero la cola repite los enlaces.|La pantalla bloquea los cambios tras un reinicio.|Служба теряет ссылку без предупреждения, а панель пропускает записи.|Форма обрезает старые комментарии после перезапуска.|The note read: "Stop. Roll back. Then call." in red letters.|Logs, traces, dumps etc. are attached.|Who owns the "old.index" bucket?|from {w} with {w} about {w} for {w} to {w} by {w}|the {w} {w} {w} the {w} during the {w}|the {w} of {w}, see the {w} and {w}|{w} {w} for {w}, {w} {w} with {w}|{W} {w} {w} after {w}.|The {w} for {w} {w}|{w}: {w} {w}|- {w} {w} for the {w}|# {w} {w}|{w}, {w} and {w}|{W} {w} {w}: {W} {w}|Der {W} verwirft die {W} am {W}, denn das {W} sperrt den {W} auf das {W}.|Die {W} kürzt {w} {W} ohne {W}.|{W}|{W} {w}|<h3>{W} {w}</h3>|\\{w}{{w}_{3}} \\{w} \\{w}|Das dauert ca. 3,5 {W}, d. h. länger als {w}.|Protokolle, {W} usw. liegen bei.|The {w} {w} {w} the {w} {w} once the {w} {w} {w}|Los {w}, {w}, etc. van {w}.|not {w}, {W}# 5 {w}|{W}<{W}> x = f(7);|» a {w} l'{w}.|{W} {w} {w} {w}{W} {w} {w} {w}{W} {W} {w}|ohne {w}{W} {W} {w} für {W}{W} {W} {w}|A {w} {w} {w} the {w}.|A {w} {w} {w} {w} {w}|Bitte z. B. {W} 4 in {w}.{w} prüfen.|während des {w} {W}, denn die {W} {w} {w} {W}|{W} {w} {w} {W} am {W}, {w} das {W} {w} {w} {W}.|Das {W} {w} {w} {W} in der {W}|{W}, {W} usw. {w} bei.|Arrêtez le {w} !|Cela {w} env. 3,5 {w}, c.-à-d. plus que {w}.|{W} {w} {w} {w} {w} {W} {w} {w} {w}|¡{W} el {w}!|¿{W} {w} {w}?|«{W} {w}?» — {w} {w}.|{W} {w} {w} {w}, {w} {w} {w} {w} {w}.
"""


def tokens(text: str) -> tuple[list[str], list[int]]:
    """Tokens of a text and where they start; breaks of lines are tokens, other white space is none."""
    found = [(m.group(), m.start()) for m in (_TOKEN if re.search(_AT, text) else _PLAIN).finditer(text)]
    return [f[0] for f in found], [f[1] for f in found]


def _table() -> tuple[list[tuple[str, list[tuple[int, int, str]]]], frozenset[str], frozenset[str]]:
    """The training table: texts with their values as (start, end, kind), the words of the patterns, and the words taken as common.

    Words of patterns are common, nine in ten of the drawn fillers too, and one
    in eight parts of names.
    """
    r = random.Random(SEED)
    draw = _Draw(r)
    patterns = [p for line in _PATTERNS.strip().split("\n") for p in line.split("|")]
    fillers = [p for line in _FILLER.strip().split("\n") for p in line.split("|")]
    makers = {"N": ("person_name", draw.name), "E": ("email", draw.email), "P": ("phone", draw.phone), "I": ("id_number", draw.id_number), "A": ("address", draw.address)}
    letters = "abcdefghijklmnoprstuvw"
    table, often = [], set()
    for _ in range(SENTENCES):
        text, spans = "", []
        for _ in range(r.choice((1, 1, 2, 3))):
            roll = r.random()
            pattern = r.choice(patterns) if roll < 0.55 else "{O}." if roll < 0.8 else r.choice(fillers)
            for piece in re.split(r"(\{[NEPIAOwW]\})", pattern):
                if len(piece) == 3 and piece[0] == "{" and piece[1] in makers:
                    kind, make = makers[piece[1]]
                    value = make()
                    spans.append((len(text), len(text) + len(value), kind))
                    often |= {w.lower() for w in re.findall(r"[^\W\d_]{3,}", value) if r.random() < (0.12 if kind == "person_name" else 0.4)}
                    text += value
                elif piece == "{O}":
                    said = draw.plain()
                    often |= {w.lower() for w in re.findall(r"[^\W\d_]+", said) if r.random() < 0.9}
                    text += said
                elif piece in ("{w}", "{W}"):
                    w = draw.word(1, 2).lower() if r.random() < 0.3 else "".join(r.choice(letters) for _ in range(r.randint(3, 9)))
                    style = r.random()
                    if style < 0.2:
                        w = w.translate(str.maketrans("aeiou", r.choice(("äéïöü", "áéíóú", "àèîôù"))))
                    elif style < 0.28:
                        w = "".join(_CYR.get(c, c) for c in w)
                    text += w.capitalize() if piece == "{W}" else w
                    if r.random() < 0.9:
                        often.add(w.lower())
                else:
                    text += piece
            text += r.choice((" ", " ", "\n", " "))
        table.append((text, spans))
    words = {w.lower() for p in (*patterns, *fillers) for w in re.findall(r"[^\W\d_]+", re.sub(r"\{\w\}", " ", p))}
    words |= {w.lower() for _ in range(400) for w in re.findall(r"[^\W\d_]+", _Draw(random.Random(_)).plain()) if w.islower() or w in ("Host", "Build", "Order", "Request", "Version", "Ticket", "Tracking", "Remote", "Ping", "Override", "Release", "Auth", "Gate", "Relay", "Ledger", "Index", "Sync", "Scheduler", "Tools", "Inc", "Port", "Dr", "Sra", "Fig", "Step", "Path", "Range", "Line", "See")}
    words |= {w for kind in ("ext", "at", "dot", "flat") for w in (kind,)}
    known = frozenset(w for w in words if len(w) > 1 or w in "àaé")
    return table, known, frozenset(often | known)


class Field:
    """A linear-chain conditional random field: weights by offset, attribute and label, and of label pairs."""

    def __init__(self) -> None:
        self.vocabulary: frozenset[str] = frozenset()
        self.common: frozenset[str] = frozenset()
        self.number: dict[str, int] = {}
        self.weights = np.zeros((len(OFFSETS), 0, len(LABELS)), np.float32)
        self.pairs = np.zeros((len(LABELS), len(LABELS)), np.float32)
        self.allowed = np.array([[b[0] != "I" or a[2:] == b[2:] for b in LABELS] for a in LABELS])
        self.begin = np.array([0.0 if x[0] != "I" else -1e4 for x in LABELS], np.float32)
        self.types: dict[str, int] = {}
        self.table = np.zeros((len(OFFSETS), 0, len(LABELS)), np.float32)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"types": {}, "table": np.zeros((len(OFFSETS), 0, len(LABELS)), np.float32)}

    def fit(self, rows: list[tuple[str, list[tuple[int, int, str]]]], vocabulary: frozenset[str], common: frozenset[str]) -> Field:
        """Maximum likelihood with a small penalty by mini-batches."""
        self.vocabulary = vocabulary
        words, gold = [], []
        for text, spans in rows:
            ws, starts = tokens(text)
            labels = [0] * len(ws)
            for s, e, kind in spans:
                inside = [i for i, (w, a) in enumerate(zip(ws, starts)) if s <= a < e or a < s < a + len(w)]
                for n, i in enumerate(inside):
                    labels[i] = LABELS.index(("I-" if n else "B-") + kind)
            words.append(ws)
            gold.append(labels)
        types = {w: i for i, w in enumerate(dict.fromkeys(w for ws in words for w in ws))}
        attrs = [attributes(w, vocabulary, common) for w in types]
        counts: dict[str, int] = {}
        for a in attrs:
            for x in a:
                counts[x] = counts.get(x, 0) + 1
        self.number = {a: i for i, a in enumerate(counts)}
        has = np.zeros((len(types) + 1, len(self.number)), np.float32)
        for i, a in enumerate(attrs):
            has[i, [self.number[x] for x in a]] = 1
        n, size = len(LABELS), len(self.number)
        w, pairs = np.zeros((len(OFFSETS), size, n), np.float32), np.zeros((n, n), np.float32)
        m, v, mp, vp = np.zeros_like(w), np.zeros_like(w), np.zeros_like(pairs), np.zeros_like(pairs)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        batches = [order[i : i + 150] for i in range(0, len(order), 150)]
        r, step = random.Random(SEED), 0
        forbidden = np.where(self.allowed, 0.0, -1e4).astype(np.float32)
        for epoch in range(EPOCHS):
            r.shuffle(batches)
            rate = 0.12 * (1 - epoch / EPOCHS) + 0.01
            for batch in batches:
                step += 1
                longest = max(len(words[i]) for i in batch)
                ids = np.full((len(batch), longest), len(types))
                real = np.zeros((len(batch), longest), bool)
                y = np.zeros((len(batch), longest), np.int64)
                for k, i in enumerate(batch):
                    ids[k, : len(words[i])] = [types[x] for x in words[i]]
                    real[k, : len(words[i])] = True
                    y[k, : len(words[i])] = gold[i]
                near = [self._shift(ids, o, len(types)) for o in OFFSETS]
                used, where = np.unique(ids, return_inverse=True)
                used = np.unique(np.concatenate([used, [len(types)]]))
                at = [np.searchsorted(used, x) for x in near]
                rows_of = has[used]
                emit = sum((rows_of @ w[o])[at[o]] for o in range(len(OFFSETS)))
                marginal, pair, _ = self._marginals(emit, pairs + forbidden, real)
                truth = np.zeros_like(marginal)
                truth[np.arange(len(batch))[:, None], np.arange(longest)[None, :], y] = 1
                error = (truth - marginal) * real[:, :, None]
                gold_pair = np.zeros((n, n), np.float32)
                both = real[:, 1:]
                np.add.at(gold_pair, (y[:, :-1][both], y[:, 1:][both]), 1)
                scale = 1 / len(batch)
                flat = error.reshape(-1, n)
                grad = np.empty_like(w)
                for o in range(len(OFFSETS)):
                    by = np.zeros((len(used), n), np.float32)
                    np.add.at(by, at[o].ravel(), flat)
                    grad[o] = rows_of.T @ by
                grad = grad * scale - 0.0005 * w
                gp = (gold_pair - pair) * scale * self.allowed - 0.0005 * pairs
                m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
                mp, vp = 0.9 * mp + 0.1 * gp, 0.99 * vp + 0.01 * gp**2
                c1, c2 = 1 - 0.9**step, 1 - 0.99**step
                w += rate * (m / c1) / (np.sqrt(v / c2) + 1e-4)
                pairs += rate * (mp / c1) / (np.sqrt(vp / c2) + 1e-4)
        self.weights, self.pairs = w, pairs + forbidden
        return self

    @staticmethod
    def _shift(ids: np.ndarray, offset: int, empty: int) -> np.ndarray:
        out = np.full_like(ids, empty)
        if offset < 0:
            out[:, -offset:] = ids[:, :offset]
        elif offset:
            out[:, :-offset] = ids[:, offset:]
        else:
            out = ids
        return out

    def _marginals(self, emit: np.ndarray, pairs: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward-backward in scaled probabilities over a padded batch."""
        b, t, n = emit.shape
        e = np.exp(emit - emit.max(2, keepdims=True))
        move = np.exp(pairs)
        forward, backward = np.empty_like(e), np.ones_like(e)
        f = e[:, 0] * np.exp(self.begin)
        forward[:, 0] = f / f.sum(1, keepdims=True)
        for i in range(1, t):
            f = (forward[:, i - 1] @ move) * e[:, i]
            f /= f.sum(1, keepdims=True)
            forward[:, i] = np.where(real[:, i, None], f, forward[:, i - 1])
        pair = np.zeros((n, n), np.float32)
        for i in range(t - 2, -1, -1):
            after = e[:, i + 1] * backward[:, i + 1]
            g = after @ move.T
            g /= np.maximum(g.sum(1, keepdims=True), 1e-30)
            live = real[:, i + 1]
            backward[:, i] = np.where(live[:, None], g, 1.0)
            joint = forward[:, i][:, :, None] * move[None] * after[:, None, :]
            joint /= np.maximum(joint.sum((1, 2), keepdims=True), 1e-30)
            pair += joint[live].sum(0)
        marginal = forward * backward
        marginal /= np.maximum(marginal.sum(2, keepdims=True), 1e-30)
        return marginal, pair, forward

    def _numbers(self, words: list[str]) -> np.ndarray:
        """Type of each token; the scores of new types are added to the table."""
        types = self.types
        new = [w for w in dict.fromkeys(words) if w not in types]
        if new:
            if len(types) > 400_000:  # scores are only kept, never needed: start again
                types.clear()
                self.table = self.table[:, :0]
                new = list(dict.fromkeys(words))
            start = len(types)
            rows = np.zeros((len(OFFSETS), len(new), len(LABELS)), np.float32)
            for k, w in enumerate(new):
                known = [self.number[a] for a in attributes(w, self.vocabulary, self.common) if a in self.number]
                rows[:, k] = self.weights[:, known].sum(1)
                types[w] = start + k
            if start == 0:
                self.table = np.concatenate([np.zeros((len(OFFSETS), 0, len(LABELS)), np.float32), rows], 1)
            else:
                self.table = np.concatenate([self.table, rows], 1)
        return np.fromiter(map(types.__getitem__, words), np.int64, len(words))

    def decode(self, sentences: list[list[str]]) -> list[np.ndarray]:
        """Best labels of many sentences, of like lengths together."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sentences)
        flat = [w for s in sentences for w in s]
        numbers = self._numbers(flat)
        bounds = np.cumsum([0, *map(len, sentences)])
        table = np.concatenate([self.table, np.zeros((len(OFFSETS), 1, len(LABELS)), np.float32)], 1)
        empty = table.shape[1] - 1
        order = sorted((i for i in range(len(sentences)) if sentences[i]), key=lambda i: len(sentences[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and end - at < LINES and (end - at + 1) * len(sentences[order[end]]) <= PADDED:
                end += 1
            batch, at = order[at:end], end
            longest = len(sentences[batch[-1]])
            ids = np.full((len(batch), longest), empty)
            for k, i in enumerate(batch):
                ids[k, : len(sentences[i])] = numbers[bounds[i] : bounds[i + 1]]
            emit = sum(table[o][self._shift(ids, off, empty)] for o, off in enumerate(OFFSETS))
            score = emit[:, 0] + self.begin
            back = np.zeros((len(batch), longest, len(LABELS)), np.int8)
            for t in range(1, longest):
                if t % 64 == 0:
                    score = score - score.max(1, keepdims=True)  # sums of long lines would lose their last digits
                step = score[:, :, None] + self.pairs[None]
                back[:, t] = step.argmax(1)
                score_next = step.max(1) + emit[:, t]
                live = ids[:, t] != empty
                score = np.where(live[:, None], score_next, score)
                back[~live, t] = np.arange(len(LABELS), dtype=np.int8)
            label = score.argmax(1)
            path = np.zeros((len(batch), longest), np.int64)
            rows = np.arange(len(batch))
            for t in range(longest - 1, -1, -1):
                path[:, t] = label
                label = back[rows, t, label]
            for k, i in enumerate(batch):
                out[i] = path[k, : len(sentences[i])]
        return out


@lru_cache(1)
def model() -> Field:
    """Trained once per process on the labelled table: a bounded set, the same whatever the data."""
    return Field().fit(*_table())


def _valid(kind: str, value: str) -> bool:
    """Whether a decoded value has the least form of its kind."""
    digits = sum(c.isdigit() for c in value)
    if kind == "email":
        return bool(re.search(rf"{_AT}|\bat\b|@", value, re.I)) and bool(re.search(r"\w\s*(?:\.|\[dot\]|\(dot\)|\bdot\b)\s*\w", value, re.I))
    if kind == "phone":
        return digits >= 7
    if kind == "id_number":
        return digits >= 5
    if kind == "address":
        return digits >= 1 and len(re.findall(r"[^\W\d_]{2,}", value)) >= 2
    parts = re.findall(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*", value)
    return value[0].isalpha() and len(parts) >= 2 and any(len(p) > 1 for p in parts) and "@" not in value


# What may stand before a decoded value and is part of it.
_LEADING = {
    "id_number": re.compile(r"(?<![\w-])[A-Z]{1,3}[ -]$"),
    "email": re.compile(r"[\w%+-][\w.%+-]*$"),
    "address": re.compile(r"(?<!\w)(?:flat|apt|apartment|suite|unit|floor)\.?\s+\w{1,5},?\s*$", re.I),
    "phone": re.compile(r"(?:\+\d{0,3} ?\(?|\()$"),
}


def _begin(kind: str, text: str, start: int) -> int:
    """Where a value really begins: with what belongs to it right before."""
    if kind in _LEADING and (m := _LEADING[kind].search(text, max(0, start - 64), start)):
        return m.start()
    return start


def _ordinary(value: str, before: str, usual: frozenset[str]) -> bool:
    """Whether a decoded name is made of common words only and nothing right before it announces a name."""
    parts = _PART.findall(value)
    if not parts or not all(p.lower() in usual for p in parts):
        return False
    return not (all(p[0].isupper() for p in parts) and before.rstrip()[-1:] in tuple("@:=\"“„«(<"))


def _windows(words: list[str]) -> list[tuple[int, int]]:
    """Lines of a text as ranges of tokens; each is decoded whole, however long it is."""
    out, start = [], 0
    for i, w in enumerate(words):
        if w[0] == "\n":
            out.append((start, i))
            start = i + 1
    out.append((start, len(words)))
    return [(a, b) for a, b in out if b > a]


def find(texts: list[str | None], field: Field, said: Counter[str] | None = None) -> list[list[tuple[str, int, int]]]:
    """Values in each text as (kind, start, end), in order.

    said: takes the counts of all tokens; names of common words then stay in,
    and only sentences that hold a common word outside the vocabulary are decoded.
    """
    sentences: list[list[str]] = []
    places: list[tuple[int, list[int]]] = []
    for i, text in enumerate(texts):
        if not text:
            continue
        words, starts = tokens(text)
        if said is not None:
            said.update(words)
        for a, b in _windows(words):
            sentences.append(words[a:b])
            places.append((i, starts[a:b]))
    if said is not None:
        asked = field.common - field.vocabulary
        holds = {w for w in said if any(p in asked for p in _PART.findall(w.lower()))}
        kept = [k for k, s in enumerate(sentences) if not holds.isdisjoint(s)]
        sentences, places = [sentences[k] for k in kept], [places[k] for k in kept]
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    usual = field.common | field.vocabulary
    for words, (i, starts), labels in zip(sentences, places, field.decode(sentences)):
        k = 0
        marked = np.flatnonzero(labels)
        while len(marked) and k < len(words):
            if labels[k] == 0:
                later = int(np.searchsorted(marked, k))
                if later == len(marked):
                    break
                k = int(marked[later])
                continue
            kind = LABELS[labels[k]][2:]
            e = k + 1
            while e < len(words) and LABELS[labels[e]] == f"I-{kind}":
                e += 1
            after = e
            while e > k + 1 and words[e - 1] in (",", ";", ":", "/", "-", "–"):
                e -= 1
            start, end = _begin(kind, texts[i], starts[k]), starts[e - 1] + len(words[e - 1].rstrip("'’"))  # type: ignore[arg-type]
            value = texts[i][start:end]  # type: ignore[index]
            if _valid(kind, value) and not (kind == "person_name" and said is None and _ordinary(value, texts[i][max(0, start - 3) : start], usual)):  # type: ignore[index]
                found[i].append((kind, start, end))
            k = after
    return found


#: What stands in place of a value.
PLACEHOLDER = {k: f"[{k.upper()}]" for k in KINDS}


def mask(text: str | None, values: list[tuple[str, int, int]]) -> str | None:
    """The text with a typed placeholder for each value, everything else unchanged."""
    if not text or not values:
        return text
    out, at = [], 0
    for kind, s, e in values:
        out += [text[at:s], PLACEHOLDER[kind]]
        at = e
    return "".join(out) + text[at:]


FIELDS = ("summary", "description_text", "body_text")


def fields(tickets: DataFrame) -> DataFrame:
    """Free texts of tickets: load_id, field, comment_pos (-1 outside comments), text; null and empty ones are left out."""
    entry = lambda name, pos, text: F.struct(F.lit(name).alias("field"), pos.cast("int").alias("comment_pos"), text.alias("text"))
    own = F.array(*[entry(f, F.lit(-1), F.col(f)) for f in FIELDS[:2]])
    said = F.transform("comments", lambda c, i: entry(FIELDS[2], i, c["body_text"]))
    every = tickets.select("load_id", F.explode(F.concat(own, F.coalesce(said, F.slice(own, 1, 0)))).alias("f")).select("load_id", "f.*")
    return every.where(F.col("text").isNotNull() & (F.col("text") != ""))


def common_words(texts: DataFrame, column: str = "text") -> frozenset[str]:
    """Words that make up at least SHARE of all words of all texts, in lower case: no more than its inverse."""
    words = texts.select(F.explode(F.regexp_extract_all(F.lower(column), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    counts, at = storage.materialise(words.groupBy("w").agg(F.count(F.lit(1)).alias("n")), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = frozenset(r[0] for r in counts.where(F.col("n") >= max(OFTEN, total * SHARE)).collect())
    storage.remove(texts.sparkSession, at)
    return found


def name_words(texts: DataFrame, field: Field, column: str = "text") -> frozenset[str]:
    """Common words of the field outside its vocabulary that are words of names: decoded as part of a name in NAMED of their occurrences outside mail addresses.

    A task gives at most one row for each common word.
    """
    shared = texts.sparkSession.sparkContext.broadcast(field)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        asked = field.common - field.vocabulary
        total: Counter[str] = Counter()
        named: Counter[str] = Counter()
        for b in it:
            own = b.column(0).to_pylist()
            said: Counter[str] = Counter()
            for text, values in zip(own, find(own, field, said)):
                for kind, s, e in values:
                    if kind == "person_name":
                        named.update(p for p in _PART.findall(text[s:e].lower()) if p in asked)
            for word, n in said.items():
                if not re.search(_AT, word):
                    for p in _PART.findall(word.lower()):
                        if p in asked:
                            total[p] += n
        words = list(total)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([named[w] for w in words], pa.int64()), pa.array([total[w] for w in words], pa.int64())], names=["w", "named", "n"])

    counts = storage.spread(texts.select(column)).mapInArrow(batches, "w string, named long, n long").groupBy("w").agg(F.sum("named").alias("named"), F.sum("n").alias("n"))
    return frozenset(r[0] for r in counts.where(F.col("named") >= F.col("n") * NAMED).collect())


def _trained(texts: DataFrame) -> Field:
    """The trained field with the common words of the texts, but for the words of names."""
    field = copy.copy(model())
    field.common = common_words(texts)
    field.types, field.table = {}, field.table[:, :0]
    field.common -= name_words(texts, field)
    return field


def detect(texts: DataFrame) -> DataFrame:
    """Values in free texts: load_id, field, comment_pos, kind, start_at (code points from 0), end_at (exclusive).

    A text is one row and nothing is shuffled; repeated rows give theirs again.
    """
    shared = texts.sparkSession.sparkContext.broadcast(_trained(texts))
    schema = "load_id long, field string, comment_pos int, kind string, start_at int, end_at int"

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for b in it:
            at, kinds, starts, ends = [], [], [], []
            for i, values in enumerate(find(b.column(3).to_pylist(), field)):
                for kind, s, e in values:
                    at.append(i)
                    kinds.append(kind)
                    starts.append(s)
                    ends.append(e)
            rows = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), rows.column(2), pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=["load_id", "field", "comment_pos", "kind", "start_at", "end_at"])

    return storage.spread(texts.select(F.col("load_id").cast("long").alias("load_id"), "field", F.col("comment_pos").cast("int").alias("comment_pos"), "text")).mapInArrow(batches, schema)


def redact(texts: DataFrame) -> DataFrame:
    """The same texts with typed placeholders: load_id, field, comment_pos, text."""
    shared = texts.sparkSession.sparkContext.broadcast(_trained(texts))
    schema = "load_id long, field string, comment_pos int, text string"

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for b in it:
            own = b.column(3).to_pylist()
            masked = [mask(t, v) for t, v in zip(own, find(own, field))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(masked, pa.string())], names=["load_id", "field", "comment_pos", "text"])

    return storage.spread(texts.select(F.col("load_id").cast("long").alias("load_id"), "field", F.col("comment_pos").cast("int").alias("comment_pos"), "text")).mapInArrow(batches, schema)
