"""Where a text stops being JSON: the position text of Python's parser, at any depth."""

from __future__ import annotations

import json
import re
from json.decoder import JSONDecodeError, scanstring

_BLANKS = re.compile(r"[ \t\n\r]*")
_ATOM = re.compile(r"true|false|null|NaN|-?Infinity|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?", re.ASCII)


def _after(text: str, at: int) -> int:
    return _BLANKS.match(text, at).end()


def _key(text: str, at: int) -> int:
    """The place of a member's value, from that of its key."""
    if text[at : at + 1] != '"':
        raise JSONDecodeError("Expecting property name enclosed in double quotes", text, at)
    at = _after(text, scanstring(text, at + 1, True)[1])
    if text[at : at + 1] != ":":
        raise JSONDecodeError("Expecting ':' delimiter", text, at)
    return _after(text, at + 1)


def scan(text: str) -> None:
    """Raise what Python's own parser raises for ``text``, or nothing if it is JSON.

    Open brackets are held in a list, so depth costs memory and no stack.
    """
    at, open_ones, ended = _after(text, 0), [], False
    while True:
        if not ended:
            start = text[at : at + 1]
            if start and start in "{[":
                close = "}" if start == "{" else "]"
                inside = _after(text, at + 1)
                if text[inside : inside + 1] == close:
                    at, ended = inside + 1, True
                    continue
                open_ones.append(close)
                at = _key(text, inside) if start == "{" else inside
                continue
            if start == '"':
                at = scanstring(text, at + 1, True)[1]
            elif atom := _ATOM.match(text, at):
                at = atom.end()
            else:
                raise JSONDecodeError("Expecting value", text, at)
            ended = True
        at = _after(text, at) if open_ones else at
        if not open_ones:
            break
        close, found = open_ones[-1], text[at : at + 1]
        if found == close:
            open_ones.pop()
            at += 1
        elif found == ",":
            comma, at = at, _after(text, at + 1)
            if text[at : at + 1] == close:
                kind = "object" if close == "}" else "array"
                raise JSONDecodeError(f"Illegal trailing comma before end of {kind}", text, comma)
            at, ended = (_key(text, at) if close == "}" else at), False
        else:
            raise JSONDecodeError("Expecting ',' delimiter", text, at)
    if (end := _after(text, at)) != len(text):
        raise JSONDecodeError("Extra data", text, end)


def message(text: str) -> str | None:
    """The message of Python's parser for a broken text; None for a sound one."""
    try:
        json.loads(text)
    except RecursionError:
        pass
    except JSONDecodeError as error:
        return str(error)
    else:
        return None
    try:
        scan(text)
    except JSONDecodeError as error:
        return str(error)
    return None
