"""Personal data: regular expressions propose spans, checksums confirm them
(Luhn for cards, mod-97 for IBANs), words near a span adjust its score.

Native Spark expressions only. Per kind one ``regexp_extract_all`` gives the
matches and, where there are any, ``split`` by the same pattern gives the
pieces between them; running sums of their lengths are the offsets (code
points, end exclusive). Matches are leftmost and do not overlap within a kind;
one of a base kind that fails its validator is dropped and not tried again. An
IBAN ends by its country's length, so what follows it is no part of it: its
pattern looks at the whole candidate but takes its first four characters only,
and a candidate that fails mod-97 hides no IBAN that begins inside it.

The base kinds ``email ip card phone`` follow fixed patterns and their spans
always stay; the context words only move their score. The added kinds ``iban
ssn local_phone`` count only when their score reaches ``MIN_SCORE``: an IBAN
by its checksum, the other two only beside a context word.

The patterns are written with possessive repeats and a look-behind that skips
the inside of a run which has already failed, so that one very long run costs
time in proportion to its length; they match what the plain patterns match.

Results for odd rows: a null or empty text has no spans; a null id stays
null; repeated rows are judged one by one; an empty table gives an empty
table; columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOCAL = r"[A-Za-z0-9._%+-]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: The base pattern with its least number of digits; shorter runs fail anyway.
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){12,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Whole lengths of IBANs and their countries: the registry of ISO 13616, and
#: countries that use IBANs without an entry in it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_IBANS = "|".join(rf"(?:{'|'.join(cc.split())})[0-9]{{2}}(?: ?+[A-Z0-9]){{{n - 4}}}" for n, cc in IBAN_LENGTHS.items())
#: Group 1 is the candidate; group 0, its first four characters, is consumed.
IBAN = rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=((?:{_IBANS})(?![A-Za-z0-9])))[A-Z0-9]{{4}}"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])"

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone")
PATTERNS = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE, IBAN, SSN, LOCAL_PHONE)))

#: Score before any context, and words that add CONTEXT_BONUS when they stand
#: within CONTEXT_CHARS before or after a span.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.3, "local_phone": 0.3}
CONTEXT = {
    "email": r"e-?mail|contact|mailto",
    "ip": r"\bip\b|address|server|host|login",
    "card": r"card|visa|master|credit|debit|payment",
    "phone": r"phone|tel\b|call|mobile|fax|contact",
    "iban": r"iban|account|bank",
    "ssn": r"\bssn\b|social security|tax id",
    "local_phone": r"phone|tel\b|call|mobile|fax",
}
CONTEXT_BONUS, CONTEXT_CHARS, MIN_SCORE = 0.2, 40, 0.5

#: Items of a run that one fold appends to.
BLOCK = 256

SPAN = "struct<kind:string,start:int,end:int,score:double>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _mod97(c: Column) -> Column:
    """ISO 13616: the first four characters go last, letters count 10 to 35."""
    s = F.regexp_replace(c, " ", "")
    moved = F.concat(F.substring(s, 5, 34), F.substring(s, 1, 4))
    value = lambda ch: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ch) - 1
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda a, ch: F.when(ch == "", a).otherwise(
        (a * F.when(value(ch) > 9, 100).otherwise(10) + value(ch)) % 97))


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        d = _digits(m)
        return F.length(d).between(13, 19) & F.when(F.length(d).between(13, 19), F.call_function("luhn_check", d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        return _mod97(m) == 1
    return F.lit(True)


def _blocks(items: Column) -> Column:
    """The items in runs of BLOCK, in order. A fold that appends copies what it
    has at every step; over runs, that is a run or the list of runs."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")), lambda k: F.slice(items, k * BLOCK + 1, BLOCK))


def _fold(items: Column, state: str, start: Column, step) -> Column:
    """The states after each run of items, where ``step(last state, run)`` is
    the state after a run; nothing for no items."""
    last = lambda out: F.coalesce(F.get(out, F.size(out) - 1), start)
    none = F.array().cast(f"array<{state}>")
    return F.when(F.size(items) > 0, F.aggregate(_blocks(items), none, lambda out, run: F.array_append(out, step(last(out), run)))).otherwise(none)


def _spans(kind: str) -> Column:
    """Spans of one kind from its matches ``_m``, the pieces between them
    ``_p`` and each match's next piece ``_n``; of an IBAN, ``_w`` is all of it."""
    names = [f"_{kind}_{x}" for x in ("pmnw" if kind == "iban" else "pmn")]
    none = F.array().cast(f"array<{SPAN}>")

    def state(pos, last, spans):
        return F.struct(pos.alias("pos"), last.alias("last"), spans.alias("spans"))

    def step(a, x):
        before, m, after = (x[n] for n in names[:3])
        start, taken = a["pos"] + F.length(before), m
        if kind == "iban":
            m = x[names[3]]
            after = F.substring(after, F.length(m) - F.length(taken) + 1, F.lit(CONTEXT_CHARS))
        near = F.concat_ws(" ", F.right(before, F.lit(CONTEXT_CHARS)), F.left(after, F.lit(CONTEXT_CHARS)))
        score = F.lit(PRIOR[kind]) + F.when(F.lower(near).rlike(CONTEXT[kind]), CONTEXT_BONUS).otherwise(0.0)
        keep = m.isNotNull() & _valid(kind, m)
        if kind not in BASE_KINDS:
            keep = keep & (score >= MIN_SCORE)
        if kind == "iban":
            # nothing begins inside a valid one
            keep = keep & (start >= a["last"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), score.alias("score"))
        spans = F.when(keep, F.array_append(a["spans"], span)).otherwise(a["spans"])
        return state(start + F.coalesce(F.length(taken), F.lit(0)), F.when(keep, start + F.length(m)).otherwise(a["last"]) if kind == "iban" else a["last"], spans)

    begin = state(F.lit(0), F.lit(0), none)
    runs = _fold(F.arrays_zip(*names), f"struct<pos:int,last:int,spans:array<{SPAN}>>", begin, lambda a, run: F.aggregate(run, state(a["pos"], a["last"], none), step))
    return F.flatten(F.transform(runs, lambda r: r["spans"]))


def find_pii(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per input row: the row itself as struct ``_row``, ``_text`` and
    one array of spans per kind, each in text order."""
    none = F.array().cast("array<string>")
    out = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("_row"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    must = {"email": F.instr("_text", "@") > 0, "phone": F.instr("_text", "+") > 0}
    out = out.withColumns({f"_{k}_m": F.when(must.get(k, F.lit(True)), F.regexp_extract_all("_text", F.lit(p), F.lit(0))).otherwise(none)
                           for k, p in PATTERNS.items()})
    out = out.withColumn("_iban_w", F.when(F.size("_iban_m") > 0, F.regexp_extract_all("_text", F.lit(IBAN), F.lit(1))).otherwise(none))
    out = out.withColumns({f"_{k}_p": F.when(F.size(f"_{k}_m") > 0, F.split("_text", p, -1)).otherwise(none) for k, p in PATTERNS.items()})
    out = out.withColumns({f"_{k}_n": F.when(F.size(f"_{k}_m") > 0, F.slice(f"_{k}_p", F.lit(2), F.size(f"_{k}_m"))).otherwise(none) for k in KINDS})
    out = out.withColumns({k: _spans(k) for k in KINDS})
    return out.drop(*[f"_{k}_{x}" for k in KINDS for x in "pmn"], "_iban_w")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_digest(df: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans and all spans of every text."""
    found = find_pii(df.select("doc_id", "text"))
    base, added = F.concat(*BASE_KINDS), F.concat(*KINDS)
    return found.select(
        F.col("_row.doc_id").alias("doc_id"), *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(added).alias("spans"),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS if k not in BASE_KINDS],
        F.round(F.array_max(F.transform(added, lambda s: s["score"])), 3).alias("top_score"))


def mask_pii(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with every span of ``text_col`` replaced by its kind
    in brackets; spans that overlap go as one, under the first one's kind. A
    null text stays null. All columns of ``df`` stay, in order."""
    found = find_pii(df, text_col)
    found = found.withColumn("_all", F.array_sort(F.transform(
        F.concat(*KINDS), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))))

    def state(pos, pieces):
        return F.struct(pos.alias("pos"), pieces.alias("pieces"))

    def step(cut):
        """Adds what lies between the last span and this one, read from the
        text from ``cut.pos`` on, and the span's kind."""
        def add(a, s):
            piece = F.concat(F.substring(cut["text"], a["pos"] - cut["pos"] + 1, s["start"] - a["pos"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
            return state(F.greatest(a["pos"], s["end"]), F.when(s["start"] >= a["pos"], F.array_append(a["pieces"], piece)).otherwise(a["pieces"]))
        return add

    def masked_run(a, run):
        # the run's part of the text, cut once
        reach = F.array_max(F.transform(run, lambda s: s["start"]))
        cut = F.struct(a["pos"].alias("pos"), F.substring(F.col("_text"), a["pos"] + 1, F.greatest(reach - a["pos"], F.lit(0))).alias("text"))
        return F.get(F.transform(F.array(cut), lambda c: F.aggregate(run, state(c["pos"], F.array().cast("array<string>")), step(c))), F.lit(0))

    runs = _fold(F.col("_all"), "struct<pos:int,pieces:array<string>>", state(F.lit(0), F.array().cast("array<string>")), masked_run)
    found = found.withColumn("_runs", runs)
    tail = F.substring(F.col("_text"), F.get(F.col("_runs"), F.size("_runs") - 1)["pos"] + 1, F.length("_text"))
    masked = F.concat(F.array_join(F.flatten(F.transform("_runs", lambda r: r["pieces"])), ""), tail)
    text = F.when(F.col("_row")[text_col].isNull(), None).when(F.size("_all") == 0, F.col("_text")).otherwise(masked)
    return found.select(*[(text if c == text_col else F.col("_row")[c]).alias(c) for c in df.columns])
