"""Personal data in texts: patterns propose, checksums confirm, nearby words adjust the score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
# Letters of context before a span that are searched for its words, and what a found word adds.
CONTEXT, BONUS = 40, 0.3
SPAN = "struct<start:int,end:int,score:double>"


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes; ``valid`` confirms; ``score`` is raised where a ``context`` word is near."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True
    needs: str = ""


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _iban_ok(match: Column) -> Column:
    """Mod 97 of the rearranged number, letter by letter, so no number grows large."""
    compact = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda acc, c: F.when(c == "", acc)
        .when(c.rlike("[0-9]"), (acc * 10 + c.cast("int")) % 97)
        .otherwise((acc * 100 + F.ascii(c) - F.lit(55)) % 97),
    )
    return F.length(compact).between(15, 34) & (rest == 1)


# Each pattern finds the spans of the plain pattern in its comment and takes linear time: runs are
# possessive, and a lookbehind starts a run at its first character only. ``\G`` allows a start right
# after the match before, which the plain pattern would find as well.
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True),
        0.9,
        r"mail|contact|write|reach",
        needs="@",
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
        0.6,
        r"\bip\b|host|server|address|login",
        needs=".",
    ),
    # [0-9]([\x20-]?[0-9])+ of 16 to 19 digits; other lengths fail anyway and are not proposed
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
        lambda m: F.call_function("luhn_check", _digits(m)),
        0.7,
        r"card|visa|master|credit|debit|pay",
    ),
    # \+[0-9][\x20().0-9-]+[0-9] of 8 to 15 digits
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda m: F.length(_digits(m)).between(8, 15),
        0.7,
        r"phone|tel|call|mobile|fax",
        needs="+",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3}+)?+(?![A-Za-z0-9])",
        _iban_ok,
        0.9,
        r"iban|account|bank|konto|cuenta|compte",
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda m: F.lit(True),
        0.4,
        r"\bssn\b|social security",
        base=False,
        needs="-",
    ),
    Kind(
        "secret",
        r"(?i)(?<![a-z])(?:password|passwd|secret|token|api[_-]?key)\s{0,3}+[=:]\s{0,3}+[\"']?+[^\s\"',;]{8,}+",
        lambda m: m.rlike("[0-9]"),
        0.8,
        r"login|key|auth|credential",
        base=False,
    ),
)
BASE = tuple(k for k in KINDS if k.base)
# Spans of the added kinds are reported from this score on; base spans always are.
LEAST = 0.6


def spans_of(text: Column, kind: Kind) -> Column:
    """Valid spans of one kind, in order: code-point offsets, end exclusive, and the score.

    The text between matches and the matches themselves add up to the offsets, in one pass over both;
    the context words are looked for at the end of the stretch before a match.
    """
    gaps = F.split(text, kind.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    # There is one stretch more than there are matches; the last pair has no match and adds nothing.
    pairs = F.zip_with(
        gaps,
        matches,
        lambda gap, match: F.struct(
            F.length(gap).alias("gap"),
            F.length(match).alias("len"),
            (match.isNotNull() & kind.valid(match)).alias("ok"),
            F.when(F.lower(F.right(gap, F.lit(CONTEXT))).rlike(kind.context), min(1.0, kind.score + BONUS))
            .otherwise(kind.score)
            .alias("score"),
        ),
    )
    state = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + p["len"]).alias("at"),
            F.when(
                p["ok"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + p["gap"]).alias("start"),
                            (acc["at"] + p["gap"] + p["len"]).alias("end"),
                            p["score"].alias("score"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
    )["spans"]
    found = state if kind.base else F.filter(state, lambda s: s["score"] >= LEAST)
    if kind.needs:
        found = F.when(F.instr(text, kind.needs) > 0, found)
    return F.coalesce(found, F.array().cast(f"array<{SPAN}>"))


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id`` and, per kind, an array of ``{start, end, score}`` over the whole text.

    Spans of different kinds may overlap; within a kind they are the leftmost ones that do not, less
    those that fail their check. A null or empty text has none. Every row is judged by itself, so ids
    may be null or repeated, other columns are ignored, and an empty table gives no rows. Nothing is
    shuffled. Time follows the text's length, plus the square of the number of valid spans of a kind
    within one document, at a few nanoseconds.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", *[spans_of(text, k).alias(k.name) for k in KINDS])


def _listed(kinds: tuple[Kind, ...]) -> Column:
    def named(kind: Kind) -> Column:
        return F.transform(F.col(kind.name), lambda s: F.concat_ws(":", F.lit(kind.name), s["start"], s["end"]))

    return F.array_join(F.concat(*[named(k) for k in kinds]), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans, all spans, and the scores in the spans' order."""
    scores = F.concat(*[F.transform(k.name, lambda s: F.format_number(s["score"], 2)) for k in KINDS])
    return found.select(
        "doc_id",
        *[F.size(k.name).cast("long").alias(f"n_{k.name}") for k in BASE],
        F.sha2(_listed(BASE), 256).alias("base_sha256"),
        _listed(KINDS).alias("spans"),
        F.array_join(scores, ",").alias("scores"),
    )


def oracle() -> str:
    """The digest of ``documents`` in DuckDB SQL: each kind's plain pattern, its check and its context words.

    DuckDB's patterns look neither back nor ahead: a kind that must not touch letters or digits is found
    with the character before it, or by the start of a candidate, and the character after is looked at.
    """
    octet = r"0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    blank = r"[ \t\n\x0B\f\r]"
    key = r"(?:password|passwd|secret|token|api[_-]?key)"
    # Pattern; how many characters of a match belong before it; what is proposed; what is valid.
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum(list_transform(string_split(reverse({digits}), ''), lambda c, i: case when i % 2 = 1 then cast(c as int) "
        "when cast(c as int) > 4 then 2 * cast(c as int) - 9 else 2 * cast(c as int) end)) % 10 = 0"
    )
    number = "case when c between '0' and '9' then cast(c as int) else ascii(c) - 55 end"
    turned = "substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4)"
    mod97 = (
        f"length(replace(m, ' ', '')) between 15 and 34 and list_reduce(list_transform(string_split({turned}, ''), lambda c: {number}), "
        "lambda a, v: case when v < 10 then (a * 10 + v) % 97 else (a * 100 + v) % 97 end, 0) = 1"
    )
    found = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "0", "true", "true"),
        "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "0", "true", rf"regexp_full_match(m, '{octet}(\.{octet}){{3}}')"),
        "card": (r"[0-9](?:[\x20-]?[0-9])+", "0", f"length({digits}) between 16 and 19", luhn),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "0", "true", f"length({digits}) between 8 and 15"),
        "iban": (
            r"(?:^|[^A-Za-z0-9])[A-Z]{2}[0-9]{2}",
            "case when regexp_matches(m, '^[A-Z]') then 0 else 1 end",
            "m is not null",
            mod97,
        ),
        "ssn": (
            r"[0-9-]+",
            "0",
            "regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}') and not regexp_matches(m, '^(000|666|9)|-00-|-0000$')",
            "true",
        ),
        "secret": (
            rf"(?i)(?:^|[^a-z]){key}{blank}{{0,3}}[=:]{blank}{{0,3}}[\"'']?[^ \t\n\x0B\f\r\"'',;]{{8,}}",
            "case when regexp_matches(m, '^[A-Za-z]') then 0 else 1 end",
            "true",
            "regexp_matches(m, '[0-9]')",
        ),
    }
    # An iban's match is what its greedy pattern takes from its start on, if no letter or digit follows.
    whole = r"^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
    taken = f"regexp_extract(substr(t, s + 1), '{whole}')"
    ends = f"not regexp_matches(substr(t, s + 1 + length({taken}), 1), '[A-Za-z0-9]')"
    ctes = ["docs as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents)"]
    for n, kind in enumerate(KINDS):
        pattern, before, proposed, valid = found[kind.name]
        name, least = kind.name, 0 if kind.base else LEAST
        match = f"case when length({taken}) > 0 and {ends} then {taken} end" if name == "iban" else "m"
        ctes.append(
            f"""{name}_cut as (select r, t, regexp_extract_all(t, '{pattern}') as ms, regexp_split_to_array(t, '{pattern}') as gs
 from docs where regexp_matches(t, '{pattern}'))"""
        )
        ctes.append(
            f"""{name}_raw as (select r, t, i, ms[i] as m, {before.replace("m,", "ms[i],")} as pre,
 list_sum(list_transform(gs[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda g: length(g))), 0) as gone
 from {name}_cut, lateral (select unnest(range(1, len(ms) + 1)) as i))"""
        )
        ctes.append(
            f"""{name}_all as (select r, t, s, {match} as m from (
 select r, t, cast(gone + pre as bigint) as s, substr(m, cast(1 + pre as bigint)) as m from {name}_raw))"""
        )
        ctes.append(
            f"""{name}_old as (select r, t, s, m, s + length(m) as e,
 coalesce(lag(s + length(m)) over (partition by r order by s), 0) as p from {name}_all where {proposed})"""
        )
        ctes.append(
            f"""{name} as (select r, {n} as k, '{name}' as name, s, e, case when regexp_matches(
  lower(right(substr(t, p + 1, s - p), {CONTEXT})), '{kind.context}') then {min(1.0, kind.score + BONUS)} else {kind.score} end as score
 from {name}_old where {valid})"""
        )
        if least:
            ctes[-1] = ctes[-1].replace(f"{name} as (", f"{name} as (select * from (", 1) + f" where score >= {least})"
    listed = "string_agg({0}, ',' order by k, s)"
    span = "name || ':' || s || ':' || e"
    base = ", ".join(f"count(*) filter (name = '{k.name}') as n_{k.name}" for k in BASE)
    zero = ", ".join(f"coalesce(n_{k.name}, 0) as n_{k.name}" for k in BASE)
    return f"""with {", ".join(ctes)},
every as ({" union all ".join(f"select * from {k.name}" for k in KINDS)}),
grouped as (select r, {base}, string_agg({span}, ',' order by k, s) filter (k < {len(BASE)}) as based,
 {listed.format(span)} as spans, {listed.format("printf('%.2f', score)")} as scores from every group by r)
select doc_id, {zero}, sha256(coalesce(based, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(scores, '') as scores
from docs left join grouped using (r)"""
