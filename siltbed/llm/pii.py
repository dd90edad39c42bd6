"""Personal data: offset-preserving deobfuscation.

Base spans are the plain patterns in the text as it stands. For disguised data, transducers rewrite the text and keep
for every character written the source span it came from: first characters (look-alike letters, digits of other scripts,
full-width and mathematical forms, invisible characters) and bracketed ``at`` and ``dot``; then, in a second reading,
bare ``at`` ... ``dot`` between words and spelled digits that stand beside a digit, a dot word or another spelled one. The same patterns run on the rewritten text, and their
spans are mapped back. A span of the first reading is added unless a base span of its kind covers it; one of the second
only where it overlaps nothing found before.

Defined results: null text counts as empty (no spans); offsets are code points, ends exclusive; repeated rows give equal
rows; an empty table gives an empty result; other columns are not carried. All scans are linear in the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame

from siltbed.llm._common import scanned

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def emails(text: str):
    """Leftmost matches: the local part is the run before an @, as far as the last match leaves it."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            low = found.end()
        at = text.find("@", max(at + 1, low))


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def detected(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end), sorted."""
    found = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# Letters of other alphabets that look like ASCII ones, and the words for digits in four languages.
LOOKALIKES = dict(
    zip(
        "аеорсухіјѕԁһԛԝьАВЕКМНОРСТУХІЈЅαοικνρυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧıɡɑօｏ",
        "aeopcyxijsdhqwbABEKMHOPCTYXIJSaoiknpuxABEZHIKMNOPTYXigaoo",
        strict=True,
    )
)
DIGIT_WORDS = (
    "zero oh null zéro cero",
    "one eins un uno",
    "two zwei deux dos",
    "three drei trois tres",
    "four vier quatre cuatro",
    "five fünf cinq cinco",
    "six sechs seis",
    "seven sieben sept siete",
    "eight acht huit ocho",
    "nine neun neuf nueve",
)
DIGIT_OF = {word: str(i) for i, words in enumerate(DIGIT_WORDS) for word in words.split()}
INVISIBLE = "\u00ad\u180e\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff"
DASHES = "\u2010\u2011\u2012\u2013\u2014\u2015\u2212\ufe63"
BLANKS = "\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
KEPT = frozenset(LOCAL) | set("@()[]{}<> ")


def plain_forms() -> dict[str, str]:
    """Character -> its plain form ("" for an invisible one), by the tables above and Unicode's compatibility forms."""
    forms = dict(LOOKALIKES) | dict.fromkeys(INVISIBLE, "") | dict.fromkeys(DASHES, "-") | dict.fromkeys(BLANKS, " ")
    for point in (*range(0x660, 0x1A00), *range(0x2460, 0x2500), *range(0xA620, 0xABFA), *range(0xFE50, 0x10000),
                  *range(0x1D400, 0x1D800), *range(0x1FBF0, 0x1FBFA)):
        c = chr(point)
        if c not in forms:
            kind = unicodedata.category(c)
            plain = str(unicodedata.decimal(c)) if kind == "Nd" else unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and plain in KEPT and kind in ("Nd", "Ll", "Lu", "Po", "Sm", "Ps", "Pe", "Pd", "Pc", "So"):
                forms[c] = plain
    return forms


FORMS = plain_forms()
STRANGE = re.compile("[" + re.escape("".join(FORMS)) + "]")
#: Scans that most texts end with: some character above the Latin ones or a rare one below; a digit word beside another or a digit.
PERHAPS_STRANGE = re.compile("[\u00a0\u00ad\u0131\u0250-\U0010ffff]")
DOT_WORD = "dot|punkt|punto|point"
# Ends of domain names after a bare "dot": all country codes and the common generic ones.
COUNTRIES = (
    "ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bv bw by bz ca cc cd "
    "cf cg ch ci ck cl cm cn co cr cu cv cw cx cy cz de dj dk dm do dz ec ee eg er es et eu fi fj fk fm fo fr ga gb gd ge gf "
    "gg gh gi gl gm gn gp gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in io iq ir is it je jm jo jp ke kg kh ki km kn "
    "kp kr kw ky kz la lb lc li lk lr ls lt lu lv ly ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz na nc "
    "ne nf ng ni nl no np nr nu nz om pa pe pf pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh si sj "
    "sk sl sm sn so sr ss st su sv sx sy sz tc td tf tg th tj tk tl tm tn to tr tt tv tw tz ua ug uk us uy uz va vc ve vg vi "
    "vn vu wf ws ye yt za zm zw"
)
GENERIC = (
    "com org net edu gov mil int info biz name pro aero coop museum jobs mobi travel tel cat asia post arpa app dev xyz "
    "online site store shop tech cloud blog club live news agency email group world space website digital media network "
    "systems solutions services company academy center life today design studio work page link one top vip fun wiki art bank "
    "berlin london nyc paris tokyo wien"
)
ENDINGS = "|".join(sorted(f"{COUNTRIES} {GENERIC}".split(), key=len, reverse=True))
# Those of them that are common words too; after a bare "dot" they end a name only where no word follows.
COMMON = "am as at be by do in is it me my no so to us"
BRACKETED = re.compile(rf"(?<!\s)\s*+[\[({{<]\s*(?:(at|@)|(?:{DOT_WORD}|\.))\s*[\])}}>]\s*", re.I)
BRACKET = re.compile(rf"[\[({{<]\s*(?:at|@|{DOT_WORD}|\.)\s*[\])}}>]", re.I)
WORDS = "|".join(sorted(DIGIT_OF, key=len, reverse=True))
BESIDE = rf"[\s,-]{{1,3}}|\s{{0,3}}\.\s{{0,3}}|\s{{1,3}}(?:{DOT_WORD})\s{{1,3}}"
SPELLED = re.compile(rf"\b(?:{WORDS})(?:[\s,-]{{1,3}}(?:{WORDS})\b)+", re.I)
#: A digit word beside a digit, a dot or another digit word: first those that stand before one, then those that stand after one.
SPELLED_BEFORE = re.compile(rf"\b(?:{WORDS})\b(?=(?:{BESIDE})(?:[0-9]|(?:{WORDS})\b))", re.I)
SPELLED_AFTER = re.compile(rf"(?<=[0-9])({BESIDE})({WORDS})\b", re.I)
PERHAPS_SPELLED = re.compile(rf"[^\w](?:{WORDS})\b(?=(?:{BESIDE})(?:[0-9]|(?:{WORDS})\b))|[0-9](?:{BESIDE})(?:{WORDS})\b")
ONE_WORD = re.compile(rf"\b(?:{WORDS})\b", re.I)
BARE_AT = re.compile(
    rf"(?<=[A-Za-z0-9])\s{{1,3}}at\s{{1,3}}(?=[A-Za-z0-9-]{{1,63}}(?:(?:\.|\s{{1,3}}(?:{DOT_WORD})\s{{1,3}})[A-Za-z0-9-]{{1,63}}){{0,8}}?"
    rf"\s{{1,3}}(?:{DOT_WORD})\s{{1,3}}(?!(?:{COMMON.replace(' ', '|')})\s{{1,3}}[a-z])(?:{ENDINGS})\b)",
    re.I,
)
BARE_DOT = re.compile(rf"(?<=[A-Za-z0-9])\s{{1,3}}(?:{DOT_WORD})\s{{1,3}}(?=[A-Za-z0-9])", re.I)
SIGN_WORD = re.compile(r"\bplus\s{1,3}(?=[0-9])|(?<=[0-9])\s{1,3}(?:dash|hyphen|minus)\s{1,3}(?=[0-9])", re.I)


class Rewritten:
    """A text with, for every character, the source span that it stands for."""

    def __init__(self, text: str, starts=None, ends=None):
        self.text = text
        self.starts = starts if starts is not None else range(len(text))
        self.ends = ends if ends is not None else range(1, len(text) + 1)

    def by(self, pattern: re.Pattern, write) -> Rewritten:
        """Every match replaced by write(match): (character, first, last place in the match) triples."""
        text, starts, ends, low = [], [], [], 0
        for m in pattern.finditer(self.text):
            text.append(self.text[low : m.start()])
            starts.extend(self.starts[low : m.start()])
            ends.extend(self.ends[low : m.start()])
            for c, first, last in write(m):
                text.append(c)
                starts.append(self.starts[first])
                ends.append(self.ends[last])
            low = m.end()
        if not low:
            return self
        text.append(self.text[low:])
        starts.extend(self.starts[low:])
        ends.extend(self.ends[low:])
        return Rewritten("".join(text), starts, ends)

    def spans(self) -> list[tuple[int, int, int]]:
        return sorted((self.starts[s], k, self.ends[e - 1]) for s, k, e in detected(self.text))


def whole(c: str):
    return lambda m: [(c, m.start(), m.end() - 1)]


def form_of(m: re.Match):
    return [(c, m.start(), m.start()) for c in FORMS[m[0]]]


def sign_of(m: re.Match):
    return [("@" if m[1] else ".", m.start(), m.end() - 1)]


def digits_of(m: re.Match):
    return [(DIGIT_OF[w[0].lower()], w.start(), w.end() - 1) for w in ONE_WORD.finditer(m.string, m.start(), m.end())]


def digit_of(m: re.Match):
    return [(DIGIT_OF[m[0].lower()], m.start(), m.end() - 1)]


def digit_after(m: re.Match):
    """The gap as it stands, and the digit."""
    return [(c, k, k) for k, c in enumerate(m[1], m.start())] + [(DIGIT_OF[m[2].lower()], m.start(2), m.end() - 1)]


def sign_word(m: re.Match):
    return [("+" if m[0][:4].lower() == "plus" else "-", m.start(), m.end() - 1)]


def added(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of disguised data that ``base`` has not."""
    first = Rewritten(text)
    if PERHAPS_STRANGE.search(text):
        first = first.by(STRANGE, form_of)
    if BRACKET.search(first.text):
        first = first.by(BRACKETED, sign_of)
    out = []
    if first.text is not text:
        known = {k: ([b for b, j, _ in base if j == k], [d for _, j, d in base if j == k]) for k in range(len(KINDS))}
        for s, k, e in first.spans():
            starts, ends = known[k]  # those of a kind do not overlap
            at = bisect_right(starts, s)
            if not at or ends[at - 1] < e:
                out.append((s, k, e))
    second, low = first, "\n" + first.text.lower()
    if PERHAPS_SPELLED.search(low):
        second = second.by(SPELLED, digits_of).by(SPELLED_BEFORE, digit_of)
        while SPELLED_AFTER.search(second.text):
            second = second.by(SPELLED_AFTER, digit_after)
    if any(w in low for w in ("dot", "punkt", "punto", "point")):
        second = second.by(BARE_AT, whole("@")).by(BARE_DOT, whole("."))
    if SIGN_WORD.search(second.text):
        second = second.by(SIGN_WORD, sign_word)
    if second is not first:
        taken = sorted(base + out)
        starts, ends = [b for b, _, _ in taken], list(accumulate((d for _, _, d in taken), max))
        for s, k, e in second.spans():
            at = bisect_left(starts, e)
            if not at or ends[at - 1] <= s:
                out.append((s, k, e))
    return out


SPANS = "array<struct<kind: string, start: long, end: long, added: boolean>>"
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())])


def spans_of(text: str | None) -> list[dict]:
    text = text or ""
    base = detected(text)
    every = sorted([(s, k, e, False) for s, k, e in base] + [(s, k, e, True) for s, k, e in added(text, base)])
    return [{"kind": KINDS[k], "start": s, "end": e, "added": new} for s, k, e, new in every]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``spans`` (kind, start, end, added), by start and then kind, for each row."""
    return scanned(
        docs, text_col, [id_col], {"spans": SPANS}, lambda texts: [list(map(spans_of, texts))], {SPANS: pa.list_(SPAN)}
    )
