"""JSON payloads and campaign tags: F10-F12, recipes R1 and R2.

Spark's JSON readers stop after the first complete value, so text behind it goes unseen.
A document is therefore parsed once as the first element of a two-element array whose
second element is the text's own 64-bit hash.  Finding the hash in second place proves
that the text was exactly one JSON value: trailing text, a second value or an early
closing bracket would move it or break the array.

That parse, into a variant, calls itself for every level, so it is limited to ``NEAR_LEVELS``.  What it
refuses is read a second time by readers that step over unknown fields without recursion, however
deep they are: no document can overflow a stack.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .keys import strip

# A text up to this long cannot have more levels, nor reach any other limit of Spark's parser.
NEAR_LEVELS = 200
_FAR = "2147483647"
_NEAR_LIMITS = {"maxNestingDepth": str(NEAR_LEVELS), "maxNumLen": _FAR, "maxStringLen": _FAR}
_FAR_LIMITS = {**_NEAR_LIMITS, "maxNestingDepth": _FAR}
# The parser takes keys of up to 50,000 characters; this limit cannot be set.
_KEY_CHARS = 50_000
# A key is shortened if it is so long and holds no escapes or control characters.
_LONG_KEY_CHARS = 1000
_NO_CONTROL = r"^[^\x00-\x1F]*\z"
# The same without characters from U+D800 on: Java matches such a range several times as fast.
_NO_CONTROL_FAST = r"^[\x20-\uD7FF]*\z"
# Python's parser takes NaN and the infinities as numbers; standard JSON does not.
_NON_FINITE = r"([\[:,]\s*)(?:NaN|-?Infinity)(?=\s*[,\]}])"
_NULL = r":\s*null(?=\s*[,}])"
_JSON_BLANKS = " \t\n\r"


def _tame(text: Column, allow_non_finite: bool) -> Column:
    """A JSON text of the same structure that the parser takes.

    Inside a string literal the swaps change letters only, never the structure.
    """

    def short_keys(t: Column) -> Column:
        return F.when(_longer(t, _KEY_CHARS), _with_short_keys(t)).otherwise(t)

    def finite(t: Column) -> Column:
        suspect = t.contains("NaN") | t.contains("Infinity")
        return F.when(suspect, F.regexp_replace(t, _NON_FINITE, "$1null")).otherwise(t)

    text = _once(text, short_keys)
    return _once(text, finite) if allow_non_finite else text


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.transform(F.array(value), use)[0]


def _longer(text: Column, chars: int) -> Column:
    """TRUE when a text has more characters, which its bytes (up to four each) mostly tell without counting."""
    size = F.octet_length(text)
    return (size > 4 * chars) | ((size > chars) & (F.length(text) > chars))


def _with_short_keys(text: Column) -> Column:
    """A text with ``_`` for every long run between two quotes that a colon follows.

    The text is parted at its quotes, and only long parts are looked at by character.
    """

    def shortened(parts: Column) -> Column:
        def short(part: Column, at: Column) -> Column:
            long = _longer(part, _LONG_KEY_CHARS - 1)
            # Behind the last quote there is no part that begins with a colon; before the first one none is a key.
            key = (at > 0) & F.get(parts, at + 1).rlike(r"^\s*:")
            plain = ~part.contains("\\") & (part.rlike(_NO_CONTROL_FAST) | part.rlike(_NO_CONTROL))
            return F.when(long & key & plain, F.lit("_")).otherwise(part)

        return F.array_join(F.transform(parts, short), '"')

    return _once(F.split(text, '"'), shortened)


@dataclass(frozen=True)
class JsonDocument:
    """A parsed text column: ``envelope`` must be bound to a column before it is read."""

    text: Column
    envelope: Column
    allow_non_finite: bool = False
    told: Column | None = None

    def bound(self, name: str, told: str | None = None) -> "JsonDocument":
        """The same document, read from the column the envelope was stored in, and the one ``is_json`` was."""
        return JsonDocument(self.text, F.col(name), self.allow_non_finite, F.col(told) if told else None)

    @property
    def _refused(self) -> Column:
        """TRUE when the text was refused and is long enough to have been so for its levels."""
        return self.envelope.isNull() & (F.length(self.text) > NEAR_LEVELS)

    def _wrapped(self, before: str, after: str) -> Column:
        return _tame(F.concat(F.lit(before), self.text, F.lit(after)), self.allow_non_finite)

    @property
    def _one_value(self) -> Column:
        """TRUE when a text of any depth is one JSON value.

        It must fit both as an element of an array and as a member of an object.  A comma outside all
        brackets breaks one of the two, as does a closing bracket, whichever it is.  The wrapped
        text is a field that no reader asks for; ``k`` behind it is read only if it was sound.
        """
        element, member = self._wrapped('{"x":[', '],"k":true}'), self._wrapped('{"x":', ',"k":true}')
        sound = [F.from_json(wrapped, "k boolean", _FAR_LIMITS)["k"] for wrapped in (element, member)]
        return sound[0].eqNullSafe(F.lit(True)) & sound[1].eqNullSafe(F.lit(True))

    @property
    def is_json(self) -> Column:
        """TRUE when the whole text is one JSON value."""
        if self.told is not None:
            return self.told
        mark = F.try_variant_get(self.envelope, "$[1]", "bigint")
        near = F.coalesce(mark == F.xxhash64(self.text), F.lit(False))
        return F.when(self._refused, self._one_value).otherwise(near)

    @property
    def is_object(self) -> Column:
        """TRUE when a JSON text is an object: a bracket then tells."""
        return F.coalesce(self.is_json & F.ltrim(self.text, F.lit(_JSON_BLANKS)).startswith("{"), F.lit(False))

    def _field(self, key: str) -> str:
        if "'" in key:
            raise ValueError(f"JSON key must not contain a quote: {key}")
        return f"$[0]['{key}']"

    def _far(self, key: str, kind: str, swap_null: bool = False) -> Column:
        """The top-level field of a document of any depth as ``kind``; ``bad`` is set where it is of another kind."""
        text = self._wrapped('{"x":', "}")
        if swap_null:
            text = F.regexp_replace(text, _NULL, ":0")
        schema = f"x struct<`{key}` {kind}>, bad string"
        return F.from_json(text, schema, {**_FAR_LIMITS, "columnNameOfCorruptRecord": "bad"})

    def has_key(self, key: str) -> Column:
        """TRUE when the top-level object of a JSON text has the key, whatever its value (null included).

        Of a refused text the field is read as an object without the fields it has: objects fit, any
        other value is marked as bad, and only a missing one is neither.
        """
        near = F.try_variant_get(self.envelope, self._field(key), "variant").isNotNull()
        probe = self._far(key, "struct<z boolean>", swap_null=True)
        far = self.is_object & _once(probe, lambda p: p["x"][key].isNotNull() | p["bad"].isNotNull())
        return F.when(self._refused, far).otherwise(near)

    def scalar(self, key: str) -> Column:
        """Text of a top-level scalar; NULL when absent, null, nested or not JSON."""
        path = self._field(key)
        value = F.try_variant_get(self.envelope, path, "variant")
        # Type names of objects and arrays list their content in angle brackets.
        nested = F.schema_of_variant(value).contains("<")
        near = F.when(self.is_json & ~nested, F.try_variant_get(self.envelope, path, "string"))

        def single(value: Column) -> Column:
            # An object or array of moderate depth can be had as text too, one too deep for that cannot.
            others = [self._far(key, kind)["x"][key] for kind in ("struct<z boolean>", "array<string>")]
            plain = ~(value.startswith("{") | value.startswith("["))
            return F.when(plain | (others[0].isNull() & others[1].isNull()), value)

        far = F.when(self.is_object, _once(self._far(key, "string")["x"][key], single))
        return F.when(self._refused, far).otherwise(near)


def parse_json_document(text: Column, allow_non_finite: bool = False) -> JsonDocument:
    """One parse of ``text``.  Store ``.envelope`` as a column, then use ``.bound(name)``.

    By default Spark's parser refuses over 1,000 digits and strings of 20 million characters; a text
    long enough for that is parsed with far limits.  That on keys (50,000 characters) cannot be set,
    so a long key is shortened first; nobody asks for it by name.  Over ``NEAR_LEVELS`` levels the
    envelope is NULL and the document's properties read the text anew, without recursion.
    """
    envelope = F.concat(F.lit("["), text, F.lit(","), F.xxhash64(text).cast("string"), F.lit("]"))
    tame = _tame(envelope, allow_non_finite)
    far = F.from_json(tame, "variant", _NEAR_LIMITS)
    near = ~_longer(text, NEAR_LEVELS)
    return JsonDocument(text, F.when(near, F.try_parse_json(tame)).otherwise(far), allow_non_finite)


def json_scalar(text: Column, key: str) -> Column:
    """F10 as one expression; prefer `parse_json_document` when several fields are read."""
    return parse_json_document(text).scalar(key)


def tag_code(tag: Column, pattern: str) -> Column:
    """first capture group of ``pattern``, stripped; NULL when the tag does not match.

    A blank capture stays an empty text: the tag did match.
    """
    return strip(F.nullif(F.regexp_extract(tag, pattern, 1), F.lit("")))
