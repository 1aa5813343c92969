"""Format-preserving pseudonyms for personal numbers and dates.

Validated values are permuted with a keyed alternating Feistel network within the set of
values of their format, so a pseudonym is again valid, has the same layout, and equal
values get equal pseudonyms in every document. E-mail addresses, which are neither numbers
nor dates, get a keyed token of fixed form.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmetric.llm.common import local_table, written

ROUNDS = 8
#: Days from 1900-01-01 to 2099-12-31: 17 * 4,297.
DATE_SIDES = (17, 4297)

_START, _END = r"(?<![0-9A-Za-z.\-+])", r"(?![0-9A-Za-z\-]|\.[0-9])"
_PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63})*\.[A-Za-z]{2,24}(?![A-Za-z0-9\-])",
    "date": r"(?<![0-9A-Za-z.\-/])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9A-Za-z\-/]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z.\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z\-]|\.[0-9])",
    "ip": r"(?<![0-9A-Za-z.\-])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9A-Za-z\-]|\.[0-9])",
}
#: Card layouts with one separator throughout: fours and a last group, 4-6-5 and 4-6-4, or no separator.
_WHOLE_CARD = r"(?:[0-9]{4}(?<w>[ \-])[0-9]{4}\k<w>[0-9]{4}\k<w>[0-9]{4}|[0-9]{4}(?<x>[ \-])[0-9]{6}\k<x>[0-9]{4,5}|[0-9]{13,19})"
_LONG_CARD = r"(?:[0-9]{4}(?<u>[ \-])[0-9]{4}\k<u>[0-9]{4}\k<u>[0-9]{4}\k<u>[0-9]{1,3})"
_SHORT_CARD = r"(?:[0-9]{4}(?<v>[ \-])[0-9]{4}\k<v>[0-9]{4}\k<v>[0-9]{1,3})"
#: Groups of a phone number are not taken out of a row of four or more groups of four.
_PHONE = (r"(?<![0-9A-Za-z.\-+(])(?![0-9]{4}(?<y>[ \-])[0-9]{4}\k<y>[0-9]{4}\k<y>[0-9]{1,4}(?![0-9]))"
          r"(?!(?<=[0-9]{4}[ \-])[0-9]{4}[ \-][0-9]{4}[ \-][0-9]{3,4}(?![0-9]))"
          r"(?:\+[0-9]{8,15}|(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\)[ .\-]?|[0-9]{2,4}[ .\-])[0-9]{3,4}[ .\-][0-9]{3,4})"
          r"(?![0-9A-Za-z\-]|\.[0-9])")
#: Scans in order; each reads what the ones before left, so a span that fails its check is matched again.
_SCANS = [
    "|".join(f"(?:{p})" for p in [*_PATTERNS.values(), f"{_START}(?:{_LONG_CARD}|{_WHOLE_CARD}|{_SHORT_CARD}){_END}"]),
    f"{_START}{_WHOLE_CARD}{_END}",  # a card before another number
    f"{_START}{_WHOLE_CARD}(?![ ][0-9]){_END}",  # a card after another number
    _PHONE,
    f"{_START}[0-9](?:[ \\-]?[0-9]){{12,18}}{_END}",  # cards in any other grouping
    f"{_START}[0-9](?:[ \\-]?[0-9]){{12,18}}?{_END}",
]
#: Stands for a settled value while the text around it is put together again; one in the text itself counts as settled.
_MARK = "\ue000"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _round(key: str, kind: str, i: str, other: str) -> str:
    """Round value from SHA-256 over key (an SQL expression), kind, round and the other half; below 2**59."""
    return f"cast(conv(substr(sha2(concat_ws('|', {key}, {kind}, {i}, {other}), 256), 1, 14), 16, 10) as bigint)"


def feistel(left: str, right: str, left_mod: str, right_mod: str, key: str, kind: str) -> str:
    """SQL for struct(l, r): a permutation of pairs below (left_mod, right_mod). Even rounds add
    a keyed function of the right half to the left one, odd rounds the other way."""
    return (f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('l', cast({left} as bigint), 'r', cast({right} as bigint)), "
            f"(a, i) -> if(i % 2 = 0, "
            f"named_struct('l', (a.l + {_round(key, kind, 'i', 'a.r')}) % {left_mod}, 'r', a.r), "
            f"named_struct('l', a.l, 'r', (a.r + {_round(key, kind, 'i', 'a.l')}) % {right_mod})))")


def _pow10(n: str) -> str:
    return f"cast(concat('1', repeat('0', {n})) as bigint)"


def digits_permuted(d: str, key: str, kind: str) -> str:
    """SQL: the digit string ``d`` (2 to 36 digits) permuted among strings of its length."""
    half = f"(length({d}) div 2)"
    rest = f"(length({d}) - length({d}) div 2)"
    tag = f"concat({kind}, length({d}))"
    pair = feistel(f"substr({d}, 1, {half})", f"substr({d}, {half} + 1)", _pow10(half), _pow10(rest), key, tag)
    return f"transform(array({pair}), p -> concat(lpad(cast(p.l as string), {half}, '0'), lpad(cast(p.r as string), {rest}, '0')))[0]"


def luhn_sum(d: str, double_last: bool) -> str:
    """SQL: Luhn sum of a digit string; ``double_last`` for a payload without its check digit."""
    odd = 0 if double_last else 1
    return (f"aggregate(sequence(1, length({d})), 0, (s, i) -> s + transform(array(cast(substr({d}, length({d}) + 1 - i, 1) as int)), "
            f"c -> if((i - 1) % 2 = {odd}, if(c > 4, 2 * c - 9, 2 * c), c))[0])")


def _fill(layout: str, d: str) -> str:
    """SQL: the digits of ``layout`` replaced in order by those of ``d``; both hold as many."""
    return (f"aggregate(sequence(1, length({layout})), named_struct('s', '', 'k', 1), (a, i) -> "
            f"if(substr({layout}, i, 1) between '0' and '9', "
            f"named_struct('s', concat(a.s, substr({d}, a.k, 1)), 'k', a.k + 1), "
            f"named_struct('s', concat(a.s, substr({layout}, i, 1)), 'k', a.k)), a -> a.s)")


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _card(m: str, key: str) -> str:
    # the first digit (network) stays, the last is the check digit of the permuted payload
    return _let("cd", f"regexp_replace({m}, '[^0-9]', '')", _let(
        "cp", f"concat(substr(cd, 1, 1), {digits_permuted('substr(cd, 2, length(cd) - 2)', key, _quoted('card'))})",
        _let("cf", f"concat(cp, cast((10 - {luhn_sum('cp', True)} % 10) % 10 as string))", _fill(m, "cf"))))


def _phone(m: str, key: str) -> str:
    # an international prefix (what stands before the last ten digits) stays
    return _let("pd", f"regexp_replace({m}, '[^0-9]', '')", _let(
        "pk", "greatest(length(pd) - 10, 0)", _let(
            "pp", f"concat(substr(pd, 1, pk), {digits_permuted('substr(pd, pk + 1)', key, _quoted('phone'))})", _fill(m, "pp"))))


def _ssn(m: str, key: str) -> str:
    area = f"cast(substr({m}, 1, 3) as int)"
    low = f"((cast(substr({m}, 5, 2) as int) - 1) * 9999 + cast(substr({m}, 8, 4) as int) - 1)"
    return _let("sp", feistel(f"if({area} > 666, {area} - 2, {area} - 1)", low, "898", "989901", key, _quoted("ssn")),
                "concat_ws('-', lpad(cast(if(sp.l >= 665, sp.l + 2, sp.l + 1) as string), 3, '0'), "
                "lpad(cast(sp.r div 9999 + 1 as string), 2, '0'), lpad(cast(sp.r % 9999 + 1 as string), 4, '0'))")


def _ip(m: str, key: str) -> str:
    return _let("ia", f"transform(split({m}, '[.]'), o -> cast(o as int))", _let(
        "ip", feistel("ia[0] * 256 + ia[1]", "ia[2] * 256 + ia[3]", "65536", "65536", key, _quoted("ip")),
        "concat_ws('.', ip.l div 256, ip.l % 256, ip.r div 256, ip.r % 256)"))


def _day_first(m: str) -> str:
    """SQL: whether a slash date only makes sense as dd/mm/yyyy."""
    return f"(substr({m}, 3, 1) = '/' AND substr({m}, 1, 2) > '12')"


def _date_format(m: str) -> str:
    return (f"CASE WHEN substr({m}, 5, 1) = '-' THEN 'yyyy-MM-dd' WHEN substr({m}, 3, 1) = '.' THEN 'dd.MM.yyyy' "
            f"WHEN {_day_first(m)} THEN 'dd/MM/yyyy' ELSE 'MM/dd/yyyy' END")


def _date_parts(m: str) -> str:
    """SQL: array of year, month, day as text."""
    return (f"CASE WHEN substr({m}, 5, 1) = '-' THEN array(substr({m}, 1, 4), substr({m}, 6, 2), substr({m}, 9, 2)) "
            f"WHEN substr({m}, 3, 1) = '.' OR {_day_first(m)} THEN array(substr({m}, 7, 4), substr({m}, 4, 2), substr({m}, 1, 2)) "
            f"ELSE array(substr({m}, 7, 4), substr({m}, 1, 2), substr({m}, 4, 2)) END")


def _days(m: str) -> str:
    """SQL: days since 1900-01-01, null for a date that isn't in the calendar."""
    return _let("dp", _date_parts(m), "datediff(try_cast(concat_ws('-', dp[0], dp[1], dp[2]) as date), date'1900-01-01')")


def _date(m: str, key: str) -> str:
    side = str(DATE_SIDES[1])
    return _let("dd", _days(m), _let(
        "dq", feistel(f"dd div {side}", f"dd % {side}", str(DATE_SIDES[0]), side, key, _quoted("date")), _let(
            "dn", f"cast(date_add(date'1900-01-01', cast(dq.l * {side} + dq.r as int)) as string)",
            f"CASE {_date_format(m)} WHEN 'yyyy-MM-dd' THEN dn "
            "WHEN 'dd.MM.yyyy' THEN concat_ws('.', substr(dn, 9, 2), substr(dn, 6, 2), substr(dn, 1, 4)) "
            "WHEN 'dd/MM/yyyy' THEN concat_ws('/', substr(dn, 9, 2), substr(dn, 6, 2), substr(dn, 1, 4)) "
            "ELSE concat_ws('/', substr(dn, 6, 2), substr(dn, 9, 2), substr(dn, 1, 4)) END")))


def _email(m: str, key: str) -> str:
    return f"concat('user-', substr(sha2(concat_ws('|', {key}, 'email', lower({m})), 256), 1, 20), '@example.invalid')"


def _kind(m: str) -> str:
    """SQL: the kind of a match, null where it doesn't validate."""
    def is_(name: str) -> str:
        bare = {"email": ".+@.+", "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4}",
                "ssn": "[0-9]{3}-[0-9]{2}-[0-9]{4}", "ip": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
                "card": r"[0-9](?:[ \-]?[0-9]){12,18}"}[name]
        return f"{m} rlike {_quoted('^(?:' + bare + ')$')}"

    digits = f"regexp_replace({m}, '[^0-9]', '')"
    return (f"CASE WHEN {is_('email')} THEN 'email' "
            f"WHEN {is_('date')} THEN if({_days(m)} between 0 and {DATE_SIDES[0] * DATE_SIDES[1] - 1}, 'date', null) "
            f"WHEN {is_('ssn')} THEN if(substr({m}, 1, 3) not in ('000', '666') and substr({m}, 1, 3) < '900' "
            f"and substr({m}, 5, 2) <> '00' and substr({m}, 8, 4) <> '0000', 'ssn', null) "
            f"WHEN {is_('ip')} THEN if(forall(split({m}, '[.]'), o -> cast(o as int) <= 255 and (o = '0' or o not like '0%')), 'ip', null) "
            f"WHEN {is_('card')} THEN {_let('kd', digits, 'if(' + luhn_sum('kd', False) + ' % 10 = 0, ' + _quoted('card') + ', null)')} "
            # three groups with blanks and no other sign of a phone are often plain numbers
            f"WHEN {m} rlike '^[0-9]+ [0-9]+ [0-9]+$' AND NOT {m} rlike '^(?:0[0-9 ]+|[2-9][0-9]{{2}} [2-9][0-9]{{2}} [0-9]{{4}})$' THEN null "
            f"ELSE if(length({digits}) between 8 and 15, 'phone', null) END")


def _scan(pattern: str, key: str) -> str:
    """SQL: __segs, with the open segments (null k) cut at the pattern's matches that validate."""
    mark, cut = _quoted(_MARK), _quoted(f"(?:{pattern})|{_MARK}")
    swapped = "CASE v.k " + " ".join(f"WHEN '{k}' THEN {f('v.t', key)}" for k, f in _SWAPS.items()) + " ELSE v.t END"
    glued = (f"array_join(flatten(zip_with(split(s.t, {cut}, -1), concat(transform(ms, m -> if(m.k is null, m.t, {mark})), array('')), "
             "(p, r) -> array(p, r))), '')")
    settled = f"transform(filter(ms, m -> m.k is not null), v -> array(named_struct('t', {swapped}, 'k', v.k)))"
    pieces = (f"flatten(zip_with(split({glued}, {mark}, -1), concat({settled}, array(cast(array() as array<struct<t: string, k: string>>))), "
              "(c, v) -> concat(array(named_struct('t', c, 'k', cast(null as string))), v)))")
    matches = f"transform(regexp_extract_all(s.t, {cut}, 0), m -> named_struct('t', m, 'k', if(m = {mark}, '', {_kind('m')})))"
    return f"flatten(transform(__segs, s -> if(s.k is not null, array(s), {_let('ms', matches, f'if(size(ms) = 0, array(s), {pieces})')})))"


def key_table(spark: SparkSession, key: str) -> DataFrame:
    """One-row table (key) in the shared scratch folder. A plan that reads it holds the path and
    not the key, so ``explain`` and event logs don't show the secret."""
    return written(local_table(spark, [(key,)], "key string"), "key")


def pseudonymise(docs: DataFrame, keys: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the text's personal values replaced, plus pii: map from kind to count.

    Kinds: card (13 to 19 digits, Luhn; network digit kept, check digit renewed), phone (8 to
    15 digits, layout and international prefix kept), ssn, ip (IPv4), date (ISO, dd.mm.yyyy,
    mm/dd/yyyy, or dd/mm/yyyy where the first number is above 12, in the calendar from 1900 to
    2099), email. Phones are three groups with hyphens or dots, three groups with blanks if they
    start with 0 or are 3-3-4 digits with both first groups from 200 on, or anything after
    ``+`` or with an area code in brackets; ten digits in a row are no phone. Cards in their usual groupings are
    settled before phones, phones before cards in any other grouping; a span that fails its
    check is matched again by the scans that follow, and stays as it is if none holds. Texts are read whole; null texts stay null with an empty map. Every row
    comes back once, with all its columns; a column named pii is replaced. ``keys`` is a
    one-row table with the column key, a secret of the caller: with it the permutations can be
    undone. It is read by a subquery and never a literal of the plan.
    """
    kept = [c for c in docs.columns if c.lower() != "pii"]
    text = F.col(f"`{text_col}`")
    named = docs.select(*[F.col(f"`{c}`") for c in kept], keys.select("key").scalar().alias("__secret"), F.array(
        F.struct(text.alias("t"), F.lit(None).cast("string").alias("k"))).alias("__segs"))
    for pattern in _SCANS:
        named = named.withColumn("__segs", F.when(text.rlike("[0-9@]"), F.expr(_scan(pattern, "__secret"))).otherwise(F.col("__segs")))
    named = named.withColumn("__kinds", F.expr("transform(filter(__segs, s -> s.k <> ''), s -> s.k)"))
    new = F.when(F.size("__kinds") == 0, text).otherwise(F.expr("array_join(transform(__segs, s -> s.t), '')"))
    counts = F.expr("map_from_entries(transform(array_distinct(__kinds), k -> struct(k, size(filter(__kinds, x -> x = k)))))")
    return named.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in kept],
                        F.coalesce(counts, F.expr("cast(map() as map<string, int>)")).alias("pii"))


_SWAPS = {"email": _email, "date": _date, "ssn": _ssn, "ip": _ip, "card": _card, "phone": _phone}


def pii_total(pii: Column | str) -> Column:
    """Number of replaced values of a ``pii`` map."""
    return F.aggregate(F.map_values(pii), F.lit(0), lambda a, b: a + b)
