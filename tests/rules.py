"""Short plain-Python statements of the scanning, cleaning and rewriting rules."""

import json
import re

TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|"[\s\S]*\Z|[{}]', re.S)


def is_object(text):
    try:
        return isinstance(json.loads(text), dict)
    except ValueError:
        return False


def strung(content, tolerant):
    """Objects of a text by brace matching over the whole text at once."""
    found, depth, start = [], 0, 0
    for token in TOKEN.finditer(content):
        mark = token.group()
        if mark == "{":
            if tolerant and depth == 0:
                start = token.start()
            depth += 1
        elif mark == "}" and not (tolerant and depth == 0):
            depth -= 1
            if depth == 0:
                found.append(content[start : token.end()])
                start = token.end()
    return [json.loads(text.strip()) for text in found if is_object(text.strip())]


def by_line(content, keep_prefix):
    found = []
    for line in content.split("\n"):
        if not line.strip():
            continue
        try:
            value = json.loads(line.strip())
        except ValueError:
            if keep_prefix:
                break
            continue
        found.append(value)
    return [value for value in found if isinstance(value, dict)]


def prefix(content):
    content = content.strip()
    found = by_line(content, True) if "\n" in content else []
    return found or strung(content, tolerant=False)


LAYOUT = "sample code snippet example syntax format script program".split()
ERRORS = "#DIV/0! #VALUE! #REF! #NAME? #NUM! #NULL! #N/A".split()


def clean(value, column):
    if value is None:
        return ""
    value = value.strip()
    if value.startswith("=") or value in ERRORS:
        return ""
    name = column.lower()
    if any(word in name for word in LAYOUT):
        lines = (re.sub("[ \t]+", " ", line.strip()) for line in value.split("\n"))
        return "\n".join(line for line in lines if line)
    return " ".join((value.lower() if "desc" in name else value).split())


def replace(node, key, old, new):
    """Copy of a node with the replacement, and whether anything changed."""
    if "." in key:
        head, _, rest = key.partition(".")
        if not isinstance(node, dict) or head not in node:
            return node, False
        if "." not in rest:
            inner = node[head]
            if not isinstance(inner, dict) or not isinstance(inner.get(rest), str) or old not in inner[rest]:
                return node, False
            return {**node, head: {**inner, rest: inner[rest].replace(old, new)}}, True
        inner, changed = replace(node[head], rest, old, new)
        return {**node, head: inner}, changed
    if isinstance(node, list):
        parts = [replace(item, key, old, new) for item in node]
        return [p for p, _ in parts], any(c for _, c in parts)
    if isinstance(node, dict):
        out, any_changed = {}, False
        for name, value in node.items():
            if name == key:
                changed = isinstance(value, str) and old in value
                value = value.replace(old, new) if changed else value
            else:
                value, changed = replace(value, key, old, new)
            out[name], any_changed = value, any_changed or changed
        return out, any_changed
    return node, False
