"""Types of JSON documents that are nested too deeply for a recursive reader: one loop over the marks of the text."""

import re
from json.decoder import JSONDecodeError, scanstring

_TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\],:])|(")|(-?(?:0|[1-9]\d*)(\.\d+)?([eE][-+]?\d+)?)|(true|false|null))')


def document_types(text: str, wrapped: dict, step: str, elements: str) -> list:
    """``(path, root, type)`` of every place of a document, by the rules of ``schema_merge``; empty if the text is not a JSON
    object; what follows the object is not read. Each open object or list keeps what its fields hold until it closes, since a name may come twice and an object may
    turn out to be a wrapped scalar."""
    try:
        return _types(text, wrapped, step, elements)
    except (ValueError, JSONDecodeError):
        return []


def _types(text: str, wrapped: dict, step: str, elements: str) -> list:
    frames, at = [], 0  # frame: [closing mark, path, root, {field: its types}, awaited, field]
    while True:
        token = _TOKEN.match(text, at)
        if not token:
            raise ValueError("not JSON")
        at, mark = token.end(), token.group(1)
        frame = frames[-1] if frames else None
        if frame and frame[4] in ("name", "first name"):
            if token.group(2):
                frame[5], at = scanstring(text, at)
                frame[4] = "colon"
                continue
            if not (mark == "}" and frame[4] == "first name"):
                raise ValueError("a name is missing")
        elif frame and frame[4] == "colon":
            if mark != ":":
                raise ValueError("a colon is missing")
            frame[4] = "value"
            continue
        elif frame and frame[4] == "comma":
            if mark == ",":
                frame[4] = "name" if frame[0] == "}" else "value"
                continue
            if mark != frame[0]:
                raise ValueError("a comma is missing")
        if mark in ("{", "["):
            if not frame and mark == "[":
                raise ValueError("no object")
            path, root = _place(frame, step, elements)
            frames.append(["}" if mark == "{" else "]", path, root, {}, "first name" if mark == "{" else "first value", None])
            continue
        if mark in ("}", "]"):
            if not frame or mark != frame[0] or frame[4] in ("value", "name"):
                raise ValueError("a value is missing")
            frames.pop()
            found = _closed(frame, wrapped, step, elements)
        elif mark or not frame:
            raise ValueError("no value")
        else:
            path, root = _place(frame, step, elements)
            if token.group(2):
                _, at = scanstring(text, at)
                kind = "string"
            elif token.group(6):
                kind = "string" if token.group(6) == "null" else "boolean"
            else:
                kind = "double" if token.group(4) or token.group(5) else _whole(int(token.group(3)))
            found = [(path, root, kind)]
        if not frames:
            return found
        _put(frames[-1], found)


def _whole(number: int) -> str:
    return "int" if -2**31 <= number < 2**31 else "long" if -2**63 <= number < 2**63 else "double"


def _place(frame, step: str, elements: str) -> tuple:
    """Path and root of the value that comes next in a frame."""
    if frame is None:
        return "", ""
    if frame[0] == "]":
        return frame[1] + step + elements, frame[2]
    inner = frame[2] or (frame[1] if frame[1].endswith(step + elements) else "")
    return frame[1] + step + frame[5], inner


def _put(frame, found: list) -> None:
    if frame[0] == "}":
        frame[3][frame[5]] = found  # of a name that comes twice the last value counts
    elif not frame[3]:
        frame[3][0] = found  # only a list's first element counts
    frame[4] = "comma"


def _closed(frame, wrapped: dict, step: str, elements: str) -> list:
    mark, path, root, fields = frame[:4]
    if mark == "}" and len(fields) == 1 and next(iter(fields)) in wrapped:
        return [(path, root, wrapped[next(iter(fields))])]
    inner = [t for found in fields.values() for t in found]
    if mark == "]":
        inner = inner or [(path + step + elements, root, "string")]
        return [*inner, (path, root, "list")]
    return [*inner, (path, root, "struct")] if path else inner
