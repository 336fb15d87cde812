"""Personal data (operator 3), DataFrame functions only.

Regular expressions propose spans, checksum validators confirm them, and words
near a span raise or lower its score. A span is found if its score reaches
``LEAST``. The base kinds (email, ip, card, phone) are found by their patterns
and checks alone and stay whatever their context."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import let

LEAST = 0.6
#: Characters before and after a span that are searched for context words.
NEAR = 40
#: Powers of two: elements of a block of a running value, and characters of a
#: chunk of a text.
BLOCK_BITS, CHUNK_BITS = 8, 10


@dataclass(frozen=True)
class Kind:
    """How spans of one kind are proposed and judged. ``guard``: a text without
    a match of it has no span (a plain necessary condition of ``pattern``).
    ``prior`` is the score without checks and context, ``proof`` what a passed
    check adds; failing a check drops the span."""

    name: str
    pattern: str
    guard: str | None = None
    check: str | None = None
    prior: float = 1.0
    proof: float = 0.0
    near: str | None = None
    raises: float = 0.0
    against: str | None = None
    lowers: float = 0.0


# The closed forms below match what the plain patterns match, from left to right
# without overlap; possessive loops and the look behind (a match starts a run of
# its characters, or where the last match ended) keep them linear on long texts.
_LOCAL = "A-Za-z0-9._%+-"
#: Countries and the signs of their IBANs, blanks not counted.
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AO25 AT20 AZ28 BA20 BE16 BF28 BG22 BH22 BI27 BJ28 BR29 BY28 CF27 CG27 CH21 CI28 CM27 "
    "CR22 CV25 CY28 CZ24 DE22 DJ27 DK18 DO28 DZ26 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GA27 GB22 GE22 GI23 "
    "GL18 GQ27 GR27 GT28 GW25 HN28 HR21 HU28 IE22 IL23 IQ23 IR26 IS26 IT27 JO30 KM27 KW30 KZ20 LB28 LC32 "
    "LI21 LT20 LU20 LV21 LY25 MA28 MC27 MD24 ME22 MG27 MK19 ML28 MN20 MR27 MT31 MU30 MZ25 NE28 NI28 NL18 "
    "NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SN28 SO23 ST25 "
    "SV28 TD27 TG28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30 "
)


def _iban_pattern() -> str:
    """An IBAN of a listed country ends at that country's length, whatever words
    follow. Other codes go as far as capitals and digits do, but not into an
    IBAN of a listed country."""
    by_length: dict[int, list[str]] = {}
    for x in IBAN_LENGTHS.split():
        by_length.setdefault(int(x[2:]), []).append(x[:2])
    listed = "|".join(x[:2] for x in IBAN_LENGTHS.split())
    own = [rf"(?:{'|'.join(c)})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])" for n, c in sorted(by_length.items())]
    other = rf"(?!{listed})[A-Z]{{2}}[0-9]{{2}}(?:(?: (?!(?:{listed})[0-9]{{2}}))?[A-Z0-9]){{11,30}}(?![A-Za-z0-9])"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join([*own, other])})"


KINDS = [
    Kind("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", guard="@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", guard=".", check="ip"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", check="card"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", guard="+", check="phone"),
    Kind("iban", _iban_pattern(), check="iban", prior=0.3, proof=0.6,
         near=r"(?i)iban|bank|account|konto|compte|cuenta|bic|swift", raises=0.1),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", guard="-", prior=0.5,
         near=r"(?i)\bssn\b|social|security|insurance|taxpayer", raises=0.4,
         against=r"(?i)order|invoice|part|serial|version|isbn", lowers=0.4),
    Kind("key", r"(?<![A-Za-z0-9])[A-Za-z0-9_-]{32,64}(?![A-Za-z0-9_-])", check="key", prior=0.4, proof=0.1,
         near=r"(?i)token|secret|password|passwd|api.?key|credential|bearer", raises=0.3,
         against=r"(?i)sha1|sha256|md5|checksum|commit|digest", lowers=0.3),
    Kind("plate_id", r"(?<![A-Za-z0-9])[A-Z]{1,2}[0-9]{6,8}(?![A-Za-z0-9])", prior=0.2,
         near=r"(?i)passport|passeport|reisepass|pasaporte|licen[cs]e no|identity card|ausweis", raises=0.6),
]
BASE = ["email", "ip", "card", "phone"]


def _mod10(digits: Column) -> Column:
    """Luhn: every second digit from the right doubled, digits of the sum."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda c: c.try_cast("int"))
    total = F.aggregate(
        F.transform(d, lambda x, i: F.when(i % 2 == 0, x).otherwise(F.when(x > 4, 2 * x - 9).otherwise(2 * x))),
        F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return total % 10 == 0


def _mod97(iban: Column) -> Column:
    """The four first signs to the end, letters as 10 to 35, remainder 1."""
    plain = F.regexp_replace(iban, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    value = F.transform(F.filter(F.split(moved, ""), lambda c: c != ""), lambda c: F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55))
    return F.aggregate(value, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def _passes(check: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]+", "")
    if check == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
        return found.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if check == "card":
        return F.length(digits).between(16, 19) & _mod10(digits)
    if check == "phone":
        return F.length(digits).between(8, 15)
    if check == "iban":
        return F.length(F.regexp_replace(found, " ", "")).between(15, 34) & _mod97(found)
    if check == "key":  # letters and digits mixed
        return found.rlike("[0-9]") & found.rlike("[A-Za-z]") & (F.length(F.regexp_replace(found, "[^0-9]+", "")) >= 6)
    raise ValueError(check)


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """The running value of a non-empty array under an associative ``join``
    (sum, greatest): first within blocks, then what the blocks before make is
    joined to each, so no array is grown by one over all elements."""

    def within(some: Column) -> Column:
        return F.aggregate(F.slice(some, 2, F.size(some)), F.slice(some, 1, 1),
                           lambda a, x: F.concat(a, F.array(join(F.get(a, F.size(a) - 1), x))))

    def blocks(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.shiftright(F.size(v) - 1, BLOCK_BITS))
        return F.transform(numbers, lambda b: within(F.slice(v, b * (1 << BLOCK_BITS) + 1, 1 << BLOCK_BITS)))

    def whole(b: Column) -> Column:
        lasts = F.transform(b, lambda x: F.get(x, F.size(x) - 1))
        return let(lasts, lambda t: let(within(t), lambda before: F.flatten(F.transform(b, lambda x, i: F.when(i == 0, x).otherwise(
            F.transform(x, lambda y: join(F.get(before, i - 1), y)))))))

    return let(values, lambda v: let(blocks(v), whole))


def chunks_of(whole: Column) -> Column:
    """A text in chunks of equal numbers of code points, so that a place in it
    is found without counting from its start."""
    return F.regexp_extract_all(whole, F.lit(f"(?s).{{1,{1 << CHUNK_BITS}}}"), F.lit(0))


def part_of(chunks: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end`` of a text in chunks."""
    size = 1 << CHUNK_BITS
    first, last = F.shiftright(start, CHUNK_BITS), F.shiftright(end, CHUNK_BITS)
    chunk = lambda i: F.coalesce(F.get(chunks, i), F.lit(""))
    at = start.bitwiseAND(size - 1) + 1
    return F.when(first == last, F.substring(chunk(first), at, end - start)).otherwise(F.concat(
        F.substring(chunk(first), at, F.lit(size)),
        F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
        F.substring(chunk(last), F.lit(1), end.bitwiseAND(size - 1))))


def _judged(n: int, kind: Kind, found: Column, ends: Column, chunks: Column, length: Column) -> Column:
    """The spans of one kind that pass its check and reach the score."""
    spans = F.transform(found, lambda x, i: F.struct(
        (F.get(ends, i) - F.length(x)).alias("start"), F.get(ends, i).alias("end"), x.alias("found")))
    if kind.check:
        spans = F.filter(spans, lambda x: _passes(kind.check, x["found"]))

    def scored(x: Column) -> Column:
        score = F.lit(kind.prior + (kind.proof if kind.check else 0.0))
        if kind.near or kind.against:
            before = part_of(chunks, F.greatest(x["start"] - NEAR, F.lit(0)), x["start"])
            around = F.concat_ws(" ", before, part_of(chunks, x["end"], F.least(x["end"] + NEAR, length)))
            if kind.near:
                score = score + F.when(around.rlike(kind.near), kind.raises).otherwise(0.0)
            if kind.against:
                score = score - F.when(around.rlike(kind.against), kind.lowers).otherwise(0.0)
        return F.struct(F.lit(n).alias("n"), x["start"].alias("start"), x["end"].alias("end"), F.lit(kind.name).alias("kind"),
                        F.round(score.cast("double"), 6).alias("score"))

    spans = F.transform(spans, scored)
    return spans if kind.name in BASE else F.filter(spans, lambda x: x["score"] >= LEAST)


def with_spans(df: DataFrame, kinds: list[Kind] = KINDS, text: str = "__tw_text") -> DataFrame:
    """Add ``__tw_spans``: an array of (kind, start, end, score), code points
    and end exclusive, by kind as listed, then by start; ``text`` has no nulls.

    The starts come from the lengths of what lies between the matches, which
    splitting by the same pattern gives."""
    whole = F.col(text)
    for k in kinds:
        found = F.regexp_extract_all(whole, F.lit(k.pattern), F.lit(0))
        between = F.split(whole, k.pattern, -1)
        if k.guard:
            none = F.array().cast("array<string>")
            found = F.when(F.contains(whole, F.lit(k.guard)), found).otherwise(none)
            between = F.when(F.contains(whole, F.lit(k.guard)), between).otherwise(none)
        df = df.withColumn(f"__tw_f_{k.name}", found)
        df = df.withColumn(f"__tw_g_{k.name}", F.when(F.size(f"__tw_f_{k.name}") > 0, between))
    in_context = [F.size(f"__tw_f_{k.name}") > 0 for k in kinds if k.near or k.against]
    df = df.withColumn("__tw_length", F.length(whole))
    df = df.withColumn("__tw_chunks", F.when(reduce(Column.__or__, in_context, F.lit(False)), chunks_of(whole)))
    for n, k in enumerate(kinds):
        f, g, e = f"__tw_f_{k.name}", f"__tw_g_{k.name}", f"__tw_e_{k.name}"
        # ends of the matches, one after another: a running sum of both lengths
        both = F.zip_with(f, F.slice(g, 1, F.size(f)), lambda x, y: F.length(x) + F.length(y))
        df = df.withColumn(e, F.when(F.size(f) > 0, running(both, lambda a, b: a + b)))
        df = df.withColumn(f"__tw_s_{k.name}", F.when(F.size(f) > 0, _judged(
            n, k, F.col(f), F.col(e), F.col("__tw_chunks"), F.col("__tw_length"))))
    empty = F.array().cast("array<struct<n:int,start:int,end:int,kind:string,score:double>>")
    df = df.withColumn("__tw_spans", F.concat(*[F.coalesce(F.col(f"__tw_s_{k.name}"), empty) for k in kinds]))
    return df.drop("__tw_length", "__tw_chunks", *[f"__tw_{c}_{k.name}" for k in kinds for c in "fges"])


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def find_private(docs: DataFrame, kinds: list[Kind] = KINDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` and
    ``found`` (the spans as structs with their scores) of every row.

    A null text is the empty text (no spans: empty list and the digest of the
    empty string); null and repeated ids stay, a row each; an empty table gives
    no rows; other columns are not read. Spans of different kinds may overlap."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__tw_text"))
    rows = with_spans(rows, kinds).drop("__tw_text")
    of = lambda name: F.size(F.filter("__tw_spans", lambda x: x["kind"] == name)).cast("long")
    return rows.select(
        "doc_id", *[of(b).alias(f"n_{b}") for b in BASE],
        F.sha2(_listed(F.filter("__tw_spans", lambda x: x["kind"].isin(BASE))), 256).alias("base_sha256"),
        _listed(F.col("__tw_spans")).alias("spans"),
        F.transform("__tw_spans", lambda x: F.struct(x["kind"], x["start"], x["end"], x["score"])).alias("found"))


def redact(docs: DataFrame, kinds: list[Kind] = KINDS, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``, each span of its text replaced by
    ``<KIND>``; of overlapping spans only the first to start (ties: the longest,
    then the kind listed first) is named and all their characters go. A null
    text stays null. ``n_chars``, if there is such a column, is counted anew
    where the text has changed."""
    row = docs.select(F.struct("*").alias("__tw_row"), F.coalesce(F.col(text), F.lit("")).alias("__tw_text"))
    row = with_spans(row, kinds)
    ordered = F.array_sort(F.transform("__tw_spans", lambda x: F.struct(
        x["start"].alias("start"), (-x["end"]).alias("rest"), x["n"].alias("n"), x["kind"].alias("kind"))))
    row = row.withColumn("__tw_order", ordered)
    # overlapping spans become one: (start, end, kind of the first); a span that
    # starts where all before it have ended begins a new one
    order, size = F.col("__tw_order"), F.size("__tw_order")

    def merged(most: Column) -> Column:
        heads = F.filter(F.sequence(F.lit(0), size - 1), lambda i: (i == 0) | (F.get(order, i)["start"] >= F.get(most, i - 1)))
        return let(heads, lambda h: F.transform(h, lambda i, j: F.struct(
            F.get(order, i)["start"].alias("start"),
            F.get(most, F.coalesce(F.get(h, j + 1), size) - 1).alias("end"),
            F.get(order, i)["kind"].alias("kind"))))

    most = running(F.transform(order, lambda x: -x["rest"]), lambda a, b: F.greatest(a, b))
    row = row.withColumn("__tw_merged", F.when(size > 0, let(most, merged)))
    whole, spans, chunks = F.col("__tw_text"), F.col("__tw_merged"), F.col("__tw_cut")
    row = row.withColumn("__tw_cut", F.when(size > 0, chunks_of(whole)))
    pieces = F.transform(spans, lambda x, i: F.concat(
        part_of(chunks, F.coalesce(F.get(spans, i - 1)["end"], F.lit(0)), x["start"]), F.lit("<"), F.upper(x["kind"]), F.lit(">")))
    tail = part_of(chunks, F.get(spans, F.size(spans) - 1)["end"], F.length(whole))
    row = row.withColumn("__tw_new", F.when(size > 0, F.concat(F.array_join(pieces, ""), tail)))
    out = []
    for f in docs.schema.fields:
        old = F.col("__tw_row")[f.name]
        if f.name == text:
            out.append(F.coalesce(F.col("__tw_new"), old).alias(f.name))
        elif f.name == n_chars:
            out.append(F.when(F.col("__tw_new").isNotNull(), F.length("__tw_new").cast(f.dataType)).otherwise(old).alias(f.name))
        else:
            out.append(old.alias(f.name))
    return row.select(*out)
