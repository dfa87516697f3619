"""Template residue, filler and error-page text in place of content.

Records become messages: characters that look alike are brought to one form,
case and accents folded, digit runs, the record's own outlet name and runs of the
printers' filler passage masked, an outlet before or behind taken off.  Messages
are counted once each and put into a prefix tree of fixed depth over their number
of tokens and first tokens (words; pieces of three characters of scripts without
blanks): only branches that
hold most of what stands under their parent are followed, for a template's
wording goes on where a headline pattern has many.  Under such a branch every
place of a message is constant, or a wildcard where tokens differ; the message
with its wildcards is its template.

A message may differ from its template in one half of it only, and a short one nowhere.
Every template is classified once, and the verdict goes back to all its records:
a ``notice`` is constant in nearly all places, holds most of its branch, and has
been sent by several outlets on several days over weeks.  A headline that several
outlets carry stays within days; one that merely mentions an error page is not
sent again and again.  No wording is listed.

Beside that, per record, a ``slot`` is an unfilled placeholder anywhere in the text.

Spread is counted by outlets and days (as bits of two 63-bit sketches, so
redelivered rows count once), and shares by rows, so nothing depends on the size of
the table but that a template must have been seen ``min_outlets`` times.  For a small
corpus the verdict table of a larger one can be passed to ``flag``.

Defined cases: a null text has a null verdict, an empty or blank one the
verdict ``empty``; other columns pass through (one called residue is replaced); an
empty table gives an empty result; repeated records get the same verdict; null
outlets and times count for no spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.characters import folding, pairs_1to1
from evidentia.scratch import Scratch
from evidentia.sources.tables import norm_domain

#: Levels of the prefix tree.
DEPTH = 3

_NAME = r"[A-Za-z][A-Za-z0-9]*(?:[_.][A-Za-z0-9]+)*"
#: Unfilled placeholders of the usual template languages. A label in single brackets ([Update]) is none.
SLOT = "|".join(
    [
        rf"\{{\{{+\s*{_NAME}\s*\}}+",
        rf"[$#]?\{{\s*{_NAME}\s*\}}",
        rf"\{{%-?\s*{_NAME}\s*-?%\}}",
        rf"<[%?]=?\s*{_NAME}\s*[%?]>",
        rf"<\${_NAME}\$>",
        rf"%\({_NAME}\)[sd]",
        rf"%{_NAME}%",
        rf"\${{1,2}}{_NAME}\${{1,2}}",
        rf"@@{_NAME}@@",
        rf"#{{1,2}}{_NAME}#{{1,2}}",
        rf"<{_NAME}>",
        rf"__{_NAME}__",
        rf"\[\[\s*{_NAME}\s*\]\]",
        r"\[(?!(?:update|video|live|photos?|audio|exclusive|breaking|opinion|analysis|actualizado|urgente?|en vivo|vivo|direct|eil)\])(?:[a-z]+(?:[_.][a-z]+)*|(?!(?:UPDATE|VIDEO|LIVE|PHOTOS?|AUDIO|EXCLUSIVE|BREAKING|OPINION|ANALYSIS|ACTUALIZADO|URGENTE?|DIRECT|EIL)\])[A-Z]{3,}(?:[_.][A-Z]+)*)\]",
    ]
)

# The words of the printers' filler passage.
PASSAGE = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua"
_FILLER = rf"(?:\b(?:{PASSAGE.replace(' ', '|')})\b[ ,.]*){{3,}}"
_LONG_WORDS = [w for w in PASSAGE.split() if len(w) > 3]
_DENSE = "[\\u3040-\\u30ff\\u3400-\\u9fff\\uac00-\\ud7af\\u0e00-\\u0e7f]"
_ENDS = " .。!"


def _plain(t: Column) -> Column:
    return F.octet_length(t) == F.length(t)


def with_message(df: DataFrame, text: str, name: str, host: str) -> DataFrame:
    """df with _residue_host, and _m: the folded and masked form of its text. A column per step, so that a step's value is looked at before its regex runs, and is computed once."""
    a, b = pairs_1to1(folding())
    t = F.col("_m")
    out = df.withColumn("_residue_host", norm_domain(host)).withColumn("_m", F.lower(F.when(F.col(text).rlike("[^\\x00-\\x7f]"), F.translate(F.col(text), a, b)).otherwise(F.col(text))))
    masked = t
    for x in (F.lower(F.col(name)), F.col("_residue_host")):
        masked = F.replace(masked, F.coalesce(F.when(F.length(x) > 2, x), F.lit("\x00")), F.lit("<src>"))
    out = out.withColumn("_m", F.rtrim(F.regexp_replace(masked, "[0-9]+", "0"), F.lit(_ENDS)))
    some = F.lit(False)
    for w in _LONG_WORDS:
        some = some | t.contains(w)
    steps = [
        (_plain(t) & some, F.regexp_replace(t, _FILLER, "<filler>")),
        (t.contains("|") | t.contains("<src>"), F.rtrim(F.regexp_replace(t, "(?:[ .。!]*(?:\\| *(?:<src>|[a-z0-9][^|{}<>]{1,40})|[–—-] *<src>))+$|^<src> ?[:|–—-] ?", ""), F.lit(_ENDS))),
        (t.endswith("(0)"), F.rtrim(F.left(t, F.length(t) - 3), F.lit(_ENDS))),
        (t.startswith("(") & t.endswith(")"), F.substring(t, F.lit(2), F.length(t) - 2)),
    ]
    for when, value in steps:
        out = out.withColumn("_m", F.when(when, value).otherwise(t))
    return out.withColumn("_m", F.ltrim(t))


def tokens(m: Column) -> Column:
    """Words, and pieces of three characters of scripts without blanks."""
    pieces = F.trim(F.regexp_replace(F.regexp_replace(m, f"({_DENSE}{{1,3}})", " $1 "), " +", " "))
    return F.split(F.when(_plain(m), m).otherwise(pieces), " ")


def has_slot(text: Column) -> Column:
    """An unfilled placeholder stands in the text (its full-width and look-alike forms brought to one before)."""
    a, b = pairs_1to1(folding())
    return F.when(text.rlike("[{}@%_$#<\\[｛｝＠％＿＄＃＜［]"), F.translate(text, a, b).rlike(SLOT)).otherwise(False)


def notice_messages(df: DataFrame, text: str = "title", name: str = "source_name", host: str = "source_domain", at: str = "published", min_outlets: int = 3, min_days: int = 3, min_span: int = 10, branch: float = 0.5, constant: float = 0.92) -> DataFrame:
    """(_m, _notice): the messages of df whose template is a notice, each once, as a written table."""
    scratch = Scratch(df.sparkSession, "residue")
    day = F.datediff(F.col(at).cast("date"), F.lit("1970-01-01").cast("date"))
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(x, F.lit(63)).cast("int"))
    rows = with_message(df.select(text, name, host, at), text, name, host).select("_m", day.alias("day"), bit(F.xxhash64("_residue_host")).alias("outlet"), F.col("_residue_host").isNotNull().alias("named"))
    spread = [F.bit_or(F.when(F.col("named"), F.col("outlet"))).alias("outlets"), F.bit_or(bit(F.col("day"))).alias("days"), F.min("day").alias("first"), F.max("day").alias("last")]
    again = [F.bit_or("outlets").alias("outlets"), F.bit_or("days").alias("days"), F.min("first").alias("first"), F.max("last").alias("last")]
    wide = (F.bit_count("outlets") >= min_outlets) & (F.bit_count("days") >= min_days) & (F.col("last") - F.col("first") >= min_span)
    counted = rows.groupBy("_m").agg(F.count(F.lit(1)).alias("n"), *spread)
    size = F.size("t")
    head = lambda k: F.xxhash64(size, F.concat_ws("\x1f", F.slice("t", 1, k)))
    messages = counted.withColumn("t", tokens(F.col("_m"))).select("_m", "n", "outlets", "days", "first", "last", size.alias("size"), head(DEPTH - 1).alias("parent"), head(DEPTH).alias("node"))
    # empty ones are left out only here: pushed further down, the condition would repeat every step of the message in the next
    messages = scratch.keep(messages, "messages").where("_m <> ''")
    # branches of the tree's last level that hold most of their parent and are spread wide enough to hold a notice
    nodes = messages.groupBy("parent", "node").agg(F.sum("n").alias("in_node"), *again)
    parents = nodes.groupBy("parent").agg(F.sum("in_node").alias("in_parent"))
    followed = nodes.where(wide).join(parents, "parent").where(F.col("in_node") >= branch * F.col("in_parent")).select("node", "in_parent")
    followed = scratch.keep(followed, "followed")  # small as a rule: written, it is sent to the messages, which are not moved
    # of a short message no place may differ, so it is a template of its own; a longer one may, in one half
    short = F.col("size") * (1 - constant) < 1
    below = messages.where(~short | wide).join(followed, "node").where(~short | (F.col("n") >= branch * F.col("in_parent"))).withColumn("t", F.when(~short, tokens(F.col("_m"))))
    half = F.floor(F.col("size") / 2).cast("int")
    halves = F.when(~short, F.array(F.xxhash64("node", F.lit(0), F.slice("t", F.lit(1), half)), F.xxhash64("node", F.lit(1), F.slice("t", half + 1, F.col("size")))))
    below = scratch.keep(below.withColumn("halves", halves).drop("t", "parent"), "below")
    strong = below.select("n", "in_parent", F.explode("halves").alias("h")).groupBy("h").agg(F.sum("n").alias("k"), F.first("in_parent").alias("in_parent")).where(F.col("k") >= branch * F.col("in_parent")).select("h")
    strong = scratch.keep(strong, "strong")
    framed = below.select("_m", "node", "n", "in_parent", F.explode("halves").alias("h")).join(strong, "h", "left_semi").drop("h").dropDuplicates(["_m"]).withColumn("t", tokens(F.col("_m")))
    # places: a token that most of the branch's rows have there is constant, others are wildcards
    each = framed.select("_m", "node", "n", "in_parent", F.posexplode("t").alias("pos", "token"))
    share = each.groupBy("node", "pos", "token").agg((F.sum("n") / F.first("in_parent") >= branch).alias("fixed"))
    placed = each.join(share, ["node", "pos", "token"]).groupBy("_m").agg(F.avg(F.col("fixed").cast("double")).alias("share"), F.array_sort(F.collect_list(F.struct("pos", F.when(F.col("fixed"), F.col("token")).alias("token")))).alias("places"))
    templates = below.drop("halves").join(placed, "_m").withColumn("template", F.xxhash64("node", "places"))
    verdict = templates.groupBy("template").agg(F.sum("n").alias("n"), F.first("in_parent").alias("in_parent"), F.first("share").alias("share"), *again)
    notices = verdict.where(wide & (F.col("share") >= constant) & (F.col("n") >= branch * F.col("in_parent"))).select("template")
    found = below.where(short).select("_m").unionByName(templates.join(notices, "template", "left_semi").select("_m"))
    # written, so that its size is known and a join with it is a broadcast only while it is small
    return scratch.keep(found.select("_m", F.lit(True).alias("_notice")), "verdict")


def flag(df: DataFrame, verdict: DataFrame, text: str = "title", name: str = "source_name", host: str = "source_domain") -> DataFrame:
    """df with the column ``residue``: null for content, else ``notice``, ``slot`` or ``empty``."""
    rows = with_message(df, text, name, host)
    kind = F.when(F.col(text).isNull(), None).when(F.col("_m") == "", "empty").when(F.col("_notice"), "notice").when(has_slot(F.col(text)), "slot")
    return rows.join(verdict, "_m", "left").withColumn("residue", kind).select(*(c for c in df.columns if c != "residue"), "residue")


def mark_residue(df: DataFrame, **columns) -> DataFrame:
    """Messages mined from df and its own rows flagged."""
    return flag(df, notice_messages(df, **columns), **{k: v for k, v in columns.items() if k in ("text", "name", "host")})
