"""Sentences of texts in several languages and scripts, all in SQL expressions.

The text is rewritten so that its length stays the same: it is split into
paragraphs at blank lines; quotations and brackets are paired, and the stops of
decimals, addresses, times, initials and abbreviations, and those inside
quotations and brackets, are replaced by private-use placeholders.  Then a mark
is put in after every stop that is left and ends a sentence by the rules of its
script, after a quotation or bracket that closes with a stop and is not followed
by the clause that reports it, after the blanks of Thai, and between the lines
of a list.  The paragraphs are split at the marks; the lengths of the pieces
give the offsets, and the sentence itself is cut from the original text by them.

Defined cases: null, empty and blank texts have no sentence; private-use
characters of the text itself split nothing; texts are taken whole (a text of n
pieces costs about 32 n steps for the offsets); repeated rows give repeated
results; other columns are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The private-use placeholders.
MARK = "\ue000"
DOT, STOP, BLANK = "\ue001", "\ue002", "\ue003"  # a stop that ends nothing; a stop, and a Thai blank, inside a quotation or bracket
OPEN, CLOSE, STRONG, LED = "\ue010", "\ue011", "\ue012", "\ue013"  # quotation; STRONG closes after a stop, LED as well and a colon led to it
BOPEN, BCLOSE, BSTRONG = "\ue014", "\ue015", "\ue016"  # bracket
USED = MARK + DOT + STOP + BLANK + OPEN + CLOSE + STRONG + LED + BOPEN + BCLOSE + BSTRONG
OTHER = "\ue0ff"  # stands for a placeholder that the text itself holds

STOPS = ".!?。！？｡．…"
WS = "\\s\\u00a0\\u1680\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u2060\\u3000\\ufeff"
_BLANKS = "".join(chr(c) for c in range(0x10000) if re.match(f"[{WS}]", chr(c), re.ASCII))
PAUSE = ",;:，；：、､"

# Abbreviations after which a sentence goes on; those a number follows; firms' forms; months after a German ordinal.
GO_ON = f"Dr|Drs|Lt|Gen|Col|Capt|Cpt|Sgt|Maj|Adm|Cmdr|St|Ste|Mt|Mr|Mrs|Ms|Prof|Rev|Sen|Rep|Gov|Sr|Sra|Srta|Dra|Mme|Mlle|Hr|Fr|Ing|Lic|Hon|vs|cf|viz|bzw|i[.{DOT}]e|e[.{DOT}]g|z[.{DOT}] ?B|d[.{DOT}] ?h|u[.{DOT}] ?a|p[.{DOT}] ?ex|p[.{DOT}] ?ej|u|Ud|Uds"
BEFORE_NUMBER = "[Nn]os?|[Nn]r|[Nn]úm|ca|env|aprox|approx|pp?|pág|Abs|Art|art|Kap|Bd|[Vv]ol|ch|[Ff]ig"
FIRM = "Ltd|KG|Inc|LLC|GmbH|OHG|AG"
MONTHS = "Jan(?:uar)?|Feb(?:ruar)?|März|Apr(?:il)?|Mai|Juni?|Juli?|Aug(?:ust)?|Sept?(?:ember)?|Okt(?:ober)?|Nov(?:ember)?|Dez(?:ember)?"
# What reports the quotation before it (Chinese clause, Japanese particle, Korean ending); what goes on after a quotation that a colon led to.
ZH_REPORT = f"[^，。！？；：{OPEN}{CLOSE}{STRONG}{LED}]{{0,24}}(?:喊道|说道|叫道|问道|答道|大喊|高喊|回答道|喊|说)[，。,]"
JA_REPORT = "[とっのはがをに]|で、"
KO_REPORT = "라고|라며|라는|라면서|이라|하고|고 |고는|며 |면서|는 "
ZH_FOLLOW = "(?:随后|然后|接着|之后|说完)?(?:便|就|即)"

_ITEM = "(?:[-*•·‣▪◦–] |\\d{1,3}[.)、．] |[(（]\\d{1,3}[)）])"
_BLANK_LINE = f"(\\n[{WS}&&[^\\n]]*\\n[{WS}]*)"


def _if(t: Column, holds: Callable[[Column], Column], *steps: tuple[str, str]) -> Column:
    """The replacements where a quick look says they can matter. The one-element array binds the text so far, which would else be written out twice."""
    def run(x: Column) -> Column:
        y = x
        for pattern, new in steps:
            y = F.regexp_replace(y, pattern, new)
        return F.when(holds(x), y).otherwise(x)

    return F.element_at(F.transform(F.array(t), run), 1)


def _inside(opener: str, closer: str, strong: str) -> tuple[tuple[str, str], ...]:
    """Stops and Thai blanks between opener and closer masked; a closer that follows a stop made strong."""
    ahead = f"(?=[^{opener}{closer}]*{closer})"
    return (f"[{STOPS}]{ahead}", STOP), (f"(?<=[\\u0E00-\\u0E7F])[ \\u00a0]{ahead}", BLANK), (f"({STOP}[{WS}]?){closer}", f"$1{strong}")


_WORD = "(?<![\\p{L}\\p{N}])"
#: Stops that end nothing, in one pass: before a small letter; in decimals, addresses and times; after initials and abbreviations.
_NO_END = (
    f"[.…](?=[{WS}]*[\\p{{Ll}}\\p{{M}}])"
    f"|(?<=\\p{{Nd}})．(?=\\p{{Nd}})"
    f"|\\.(?:(?<=\\p{{Nd}}\\.)(?=\\p{{Nd}})"
    f"|(?<=[A-Za-z0-9]\\.)(?=[a-z0-9])"
    f"|(?<={_WORD}[A-Za-zÀ-ÖØ-öø-ÿ]\\.)(?=[{WS}]*\\p{{L}})"
    f"|(?<={_WORD}(?:{GO_ON})\\.)(?=[{WS}]*[^{WS}])"
    f"|(?<={_WORD}(?:{BEFORE_NUMBER})\\.)(?=[{WS}]*\\p{{N}})"
    f"|(?<={_WORD}(?:Co|Cía)\\.)(?=[{WS}]*(?:{FIRM}))"
    f"|(?<=\\p{{Nd}}\\.)(?=[{WS}]*(?:{MONTHS})(?!\\p{{L}})))"
)


def _paragraph(t: Column) -> Column:
    """A paragraph of running text with marks after its sentences."""
    for a, b in (("„", "“”"), ("“", "”"), ("«", "»"), ("「", "」"), ("『", "』"), ('"', '"'), ("‹", "›")):
        t = _if(t, lambda x, a=a: x.contains(a), (f"{a}([^{a}{b}]*+)[{b}]", f"{OPEN}$1{CLOSE}"))
    for a, b in (("(", ")"), ("（", "）"), ("【", "】")):
        t = _if(t, lambda x, a=a: x.contains(a), (f"[{a}]([^{a}{b}]*+)[{b}]", f"{BOPEN}$1{BCLOSE}"))
    t = F.regexp_replace(t, _NO_END, DOT)
    t = _if(t, lambda x: x.contains(OPEN), *_inside(OPEN, CLOSE, STRONG), (f"([：:][{WS}]?{OPEN}[^{OPEN}{CLOSE}{STRONG}]*){STRONG}", f"$1{LED}"))
    t = _if(t, lambda x: x.contains(BOPEN), *_inside(BOPEN, BCLOSE, BSTRONG))
    # ends of sentences
    stay = f"(?![{STOPS}{PAUSE}])(?![{WS}]*\\p{{Ll}})"
    t = F.regexp_replace(t, f"([{STOPS}]+[{CLOSE}{STRONG}{LED}{BCLOSE}{BSTRONG}”’»」』）)\\]]*){stay}", f"$1{MARK}")
    alone = f"{stay}(?![{MARK}{CLOSE}{STRONG}{BCLOSE}{BSTRONG}])(?!{JA_REPORT}|{KO_REPORT}|{ZH_REPORT})"
    t = _if(t, lambda x: x.contains(OPEN), (f"{STRONG}{alone}", f"{STRONG}{MARK}"), (f"{LED}{alone}(?!{ZH_FOLLOW})", f"{LED}{MARK}"))
    t = _if(t, lambda x: x.contains(BSTRONG), (f"{BSTRONG}{stay}(?!{MARK})", f"{BSTRONG}{MARK}"))
    # Thai: a blank ends a sentence (not the one after the repetition sign)
    return F.regexp_replace(t, f"(?<=[\\u0E00-\\u0E45\\u0E47-\\u0E7F])([ \\u00a0\\u3000]+)(?=[\\u0E00-\\u0E7F{OPEN}{BOPEN}])", f"$1{MARK}")


def units(text: Column) -> Column:
    """The pieces of a text, as an array: together as long as the text, each a sentence with blanks around it or blanks alone."""
    t = F.translate(text, USED, OTHER * len(USED))
    paragraphs = F.split(F.regexp_replace(t, _BLANK_LINE, f"$1{MARK}"), MARK)

    def cut(p: Column) -> Column:
        items = F.regexp_replace(p, f"(\\n)(?=[ \\t]*{_ITEM})", f"$1{MARK}")
        return F.split(F.when(p.rlike(f"^[{WS}]*{_ITEM}"), items).otherwise(_paragraph(p)), MARK)

    return F.flatten(F.transform(paragraphs, cut))


def sentences(df: DataFrame, text: str = "text", id: str = "doc_id", chunk: int = 64) -> DataFrame:
    """(id, sent_start, sent_end): offsets in code points of every sentence, end exclusive, no blanks at either end."""
    name, id = id, "_row"
    rows = df.where(F.col(text).isNotNull()).select(F.col(name).alias(id), units(F.col(text)).alias("u"))
    # lengths by chunks, so that the running sums cost little for long texts too
    at = F.sequence(F.lit(0), F.floor((F.size("u") - 1) / chunk).cast("int"))
    rows = rows.select(id, F.transform(at, lambda i: F.slice("u", i * chunk + 1, chunk)).alias("c"))
    total = F.transform("c", lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda s, x: s + F.length(x)))
    starts = F.aggregate(total, F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("all")), lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")), lambda s: s["all"])
    chunks = rows.select(id, F.explode(F.arrays_zip(F.col("c").alias("c"), starts.alias("s"))).alias("z")).select(id, F.col("z.c").alias("c"), F.col("z.s").alias("s"))
    empty = F.array().cast("array<struct<a:bigint,x:string>>")
    placed = F.aggregate("c", F.struct(F.col("s").alias("at"), empty.alias("all")), lambda s, x: F.struct((s["at"] + F.length(x)).alias("at"), F.concat(s["all"], F.array(F.struct(s["at"].alias("a"), x.alias("x")))).alias("all")), lambda s: s["all"])
    pieces = chunks.select(id, F.explode(placed).alias("p")).select(id, F.col("p.a").alias("a"), F.col("p.x").alias("x"))
    left = F.length("x") - F.length(F.ltrim("x", F.lit(_BLANKS)))
    body = F.length(F.btrim("x", F.lit(_BLANKS)))
    return pieces.select(F.col(id).alias(name), (F.col("a") + left).alias("sent_start"), (F.col("a") + left + body).alias("sent_end")).where("sent_end > sent_start")
