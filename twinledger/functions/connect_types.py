"""Values of a change log as the capture writes them: Connect's logical types in JSON.

A decimal comes as base64 of its unscaled value (big-endian two's complement, the scale is in the
schema), a date as days, a time as milliseconds of the day, a timestamp as epoch milliseconds. Which
of these a field is stands in the schema inside the record, so decoding follows each record's own schema.
Everything is built-in functions: exact up to 38 digits in columns of numbers, of any length in columns of text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of logical types.
DECIMAL = "org.apache.kafka.connect.data.Decimal"
VARIABLE_DECIMAL = "io.debezium.data.VariableScaleDecimal"
DATES = ("org.apache.kafka.connect.data.Date", "io.debezium.time.Date")
TIMES = ("org.apache.kafka.connect.data.Time", "io.debezium.time.Time", "io.debezium.time.MicroTime",
         "io.debezium.time.NanoTime")
TIMESTAMPS = ("org.apache.kafka.connect.data.Timestamp", "io.debezium.time.Timestamp",
              "io.debezium.time.MicroTimestamp", "io.debezium.time.NanoTimestamp")

_MAX_BYTES = 16

# The functions below write SQL text, so that a whole row image is one expression to be built.


def _let(name: str, value: str, body: str) -> str:
    """``body`` with the value under ``name``, worked out once however often it occurs."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _refuse(why: str, value: str) -> str:
    return f"raise_error(concat('{why}', coalesce({value}, 'NULL')))"


def _whole(raw: str) -> str:
    """Text of a two's-complement integer of up to 16 bytes given in hexadecimal; null if it is longer."""
    sign = f"if({raw} >= '8', 'F', '0')"
    short = f"conv(lpad({raw}, {_MAX_BYTES}, {sign}), 16, -10)"  # up to 8 bytes
    high = f"cast(conv(substring(wide, 1, {_MAX_BYTES}), 16, -10) AS decimal(20,0))"
    low = f"cast(conv(substring(wide, {_MAX_BYTES + 1}), 16, 10) AS decimal(20,0))"
    word = "cast('18446744073709551616' AS decimal(20,0))"
    # of a negative number the upper word is one too small: with it the product might not fit where the number does
    size = f"if(wide >= '8', cast(({high} + 1) * {word} AS decimal(38,0)) - ({word} - {low}), cast({high} * {word} AS decimal(38,0)) + {low})"
    both = _let("wide", f"lpad({raw}, {2 * _MAX_BYTES}, {sign})", f"cast(cast({size} AS decimal(38,0)) AS string)")
    return f"CASE WHEN length({raw}) BETWEEN 2 AND {_MAX_BYTES} THEN {short} WHEN length({raw}) BETWEEN {_MAX_BYTES + 1} AND {2 * _MAX_BYTES} THEN {both} END"


def _whole_of_any_length(raw: str) -> str:
    """Text of a two's-complement integer of any length; null if there is none.

    The bits are taken 28 at a time into groups of ten digits, the lowest first.
    """
    # the upper byte tells that the number is below 75 * 2^120, which has 38 digits
    top = f"substring({raw}, 1, 2)"
    fits = f"(length({raw}) < {2 * _MAX_BYTES} OR length({raw}) = {2 * _MAX_BYTES} AND ({top} < '4B' OR {top} > 'B4'))"
    limb = "cast(conv(substring(wide, start, 7), 16, 10) AS bigint)"
    # of a negative number the bits are turned, which gives -x - 1
    limb = f"if(wide >= '8', 268435455 - {limb} + if(start + 7 > length(wide), 1, 0), {limb})"
    none = "cast(array() AS array<bigint>)"
    moved = "part * 268435456 + held.carry"
    step = (f"aggregate(parts, named_struct('carry', limb, 'done', {none}), (held, part) -> named_struct("
            f"'carry', ({moved}) div 10000000000, 'done', concat(held.done, array(({moved}) % 10000000000))), "
            "held -> if(held.carry > 0, concat(held.done, array(held.carry)), held.done))")
    parts = f"aggregate(transform(sequence(1, length(wide), 7), start -> {limb}), {none}, (parts, limb) -> {step})"
    digits = "ltrim('0', array_join(transform(reverse(parts), part -> lpad(cast(part AS string), 10, '0')), ''))"
    text = f"concat(if(wide >= '8', '-', ''), {_let('parts', parts, f"if(size(parts) > 0, {digits}, '0')")})"
    wide = f"lpad({raw}, (length({raw}) + 6) div 7 * 7, if({raw} >= '8', 'F', '0'))"
    return f"CASE WHEN {fits} THEN {_whole(raw)} ELSE {_let('wide', wide, text)} END"


def _placed(whole: str, scale: str) -> str:
    """Text of an integer with the point where the scale puts it."""
    point = f"concat(substring(t, 1, length(t) - {scale}), '.', substring(t, length(t) - {scale} + 1, {scale}))"
    digits = f"ltrim('-', {whole})"
    padded = f"lpad({digits}, greatest(length({digits}), {scale} + 1), '0')"
    return (f"CASE WHEN {scale} = 0 THEN {whole} WHEN {scale} < 0 THEN concat({whole}, repeat('0', -{scale})) "
            f"ELSE concat(if(startswith({whole}, '-'), '-', ''), {_let('t', padded, point)}) END")


def _number(encoded: str, scale: str, body: str, any_length: bool) -> str:
    """``body`` of an encoded decimal, which finds its integer and scale under ``number``."""
    whole = (_whole_of_any_length if any_length else _whole)("raw")
    refuse = _refuse("not a decimal: " if any_length else "not a decimal of up to 38 digits: ", encoded)
    number = _let("raw", f"hex(unbase64({encoded}))", f"named_struct('whole', {whole}, 'scale', cast({scale} AS int))")
    return f"if({encoded} IS NOT NULL, coalesce({_let('number', number, body)}, {refuse}), NULL)"


def decimal_text(encoded: str, scale: str, any_length: bool = False) -> str:
    """Plain decimal text of an encoded decimal; what has more than 38 digits fails, but for ``any_length``."""
    return _number(encoded, scale, _placed("number.whole", "number.scale"), any_length)


def decimal_value(encoded: str, scale: str, target: T.DataType) -> str:
    """An encoded decimal in a type of numbers; it fails when its decimals would be rounded."""
    name, text = target.simpleString(), _placed("number.whole", "number.scale")
    if not isinstance(target, (T.DecimalType, T.IntegralType)):
        return _number(encoded, scale, f"cast({text} AS {name})", any_length=False)
    places = getattr(target, "scale", 0)
    plain = "number.whole" if places == 0 else "concat(number.whole, 'E-', number.scale)"
    value = f"if(number.scale BETWEEN 0 AND {places}, cast({plain} AS {name}), cast({_let('shown', text, exact('shown', places))} AS {name}))"
    return _number(encoded, scale, value, any_length=False)


def encoded_decimal(value: Column, scale: int) -> Column:
    """Base64 of a decimal of up to 18 digits as the capture writes it, in as few bytes as hold the sign."""
    whole = (value * F.lit(10 ** scale)).cast("bigint")
    wide = F.lpad(F.hex(whole), 16, "0")
    short = F.regexp_replace(F.regexp_replace(wide, "^(?:00)+(?=[0-7][0-9A-F])", ""), "^(?:FF)+(?=[89A-F][0-9A-F])", "")
    return F.base64(F.unhex(short))


def exact(text: str, scale: int) -> str:
    """The decimal text itself; it fails when decimals beyond ``scale`` would be rounded away."""
    beyond = rf"{text} RLIKE r'\.\d{{{scale}}}\d*[1-9]'"
    return f"if({beyond}, {_refuse(f'more than {scale} decimals: ', text)}, {text})"


def _is(kind: str, *names: str) -> str:
    return f"{kind} IN ({', '.join(repr(n) for n in names)})"


def _micros(value: str, kind: str) -> str:
    """Microseconds of a time or timestamp; most kinds count milliseconds."""
    count = f"cast({value} AS bigint)"
    return (f"CASE WHEN contains({kind}, '.MicroTime') THEN {count} "
            f"WHEN contains({kind}, '.NanoTime') THEN ({count} - pmod({count}, 1000)) div 1000 ELSE {count} * 1000 END")


def _since_epoch(micros: str) -> str:
    """Timestamp without zone so many microseconds behind the epoch."""
    return f"(TIMESTAMP_NTZ '1970-01-01 00:00:00' + INTERVAL '0.000001' SECOND * ({micros}))"


def _decimal(value: str, kind: str, scale: str, body: Callable[[str, str], str]) -> str:
    """``body`` of the encoded text and the scale, which a variable decimal carries in its value."""
    parts = (f"named_struct('v', get_json_object({value}, '$.value'), 's', get_json_object({value}, '$.scale'))",
             f"named_struct('v', {value}, 's', {scale})")
    return _let("given", f"if({_is(kind, VARIABLE_DECIMAL)}, {parts[0]}, {parts[1]})", body("given.v", "given.s"))


def _text(value: str, kind: str, scale: str) -> str:
    """What a field says, as plain text."""
    stamp = f"cast({_since_epoch(_micros(value, kind))} AS string)"
    return (
        f"CASE WHEN {kind} IS NULL THEN {value} "
        f"WHEN {_is(kind, DECIMAL, VARIABLE_DECIMAL)} THEN {_decimal(value, kind, scale, partial(decimal_text, any_length=True))} "
        f"WHEN {_is(kind, *DATES)} THEN cast(date_from_unix_date(cast({value} AS int)) AS string) "
        f"WHEN {_is(kind, *TIMES)} THEN substring_index({stamp}, ' ', -1) "
        f"WHEN {_is(kind, *TIMESTAMPS)} THEN {stamp} ELSE {value} END")


def decoded(value: str, kind: str, scale: str, target: T.DataType) -> str:
    """SQL of one field of a row image in the type of its column.

    ``value`` is the JSON value as text, ``kind`` the name of its logical type (null for a plain one) and
    ``scale`` that of a decimal. A value that does not fit the type, or whose decimals would be rounded, fails.
    """
    if isinstance(target, T.BinaryType):
        return f"unbase64({value})"
    if isinstance(target, T.StringType):
        return _text(value, kind, scale)
    plain = f"cast({value} AS {target.simpleString()})"
    out = f"CASE WHEN {kind} IS NULL THEN {plain}"
    if isinstance(target, T.DateType):
        out += f" WHEN {_is(kind, *DATES)} THEN date_from_unix_date(cast({value} AS int))"
    elif isinstance(target, T.TimestampType):  # the capture counts in UTC
        out += f" WHEN {_is(kind, *TIMESTAMPS)} THEN timestamp_micros({_micros(value, kind)})"
    elif isinstance(target, T.TimestampNTZType):
        out += f" WHEN {_is(kind, *TIMESTAMPS)} THEN {_since_epoch(_micros(value, kind))}"
    elif isinstance(target, T.NumericType):
        number = _decimal(value, kind, scale, partial(decimal_value, target=target))
        out += f" WHEN {_is(kind, DECIMAL, VARIABLE_DECIMAL)} THEN {number}"
    return f"{out} ELSE {plain} END"
