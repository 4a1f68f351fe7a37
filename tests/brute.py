"""Plain Python versions of the per-line rules, written as scanners, to check the expressions against."""

import string

from dumpscope.constants import END_MARKER, TITLE_MARKER

WORD = set(string.ascii_letters + string.digits + "_")
SPACE = set(" \t\n\r\x0b\x0c")


def clean(topic):
    for separator in "|#":
        topic = topic.partition(separator)[0]
    return topic if topic and ":" not in topic and all(c in string.printable for c in topic) else None


def wikilinks(line):
    found, at = [], 0
    while (a := line.find("[[", at)) >= 0 and (b := line.find("]]", a + 2)) >= 0:
        found.append(line[a + 2 : b])
        at = b + 2
    return [t for t in map(clean, found) if t]


def nested(line):
    found, at = [], 0
    while (a := line.find("[[", at)) >= 0 and (b := line.find("]]", a + 2)) >= 0:
        found.append(line[a + 2 : b].strip())
        at = a + 2
    return [t for t in map(clean, found) if t]


def bold(line):
    found, at = [], 3
    while at <= len(line):
        end = at
        while end < len(line) and line[end] in WORD | SPACE:
            end += 1
        if line[at - 3 : at] == "'''" == line[end : end + 3]:
            found.append(line[at:end])
            at = max(end, at + 1)
        else:
            at += 1
    return found


def headings(line, level=None):
    bars = "=" * (level or 2)
    inner = line[len(bars) : -len(bars)]
    if len(line) < 2 * len(bars) or not (line.startswith(bars) and line.endswith(bars)):
        return []
    if level and (len(inner) < 2 or inner[0] == "=" or inner[-1] == "="):
        return []
    return [line.strip("=")]


def is_prose(line):
    return line.startswith("[[") and not line.startswith("[[File:") or line[:1] in WORD and line != ""


def _cut(line, opening, closing):
    """Drop closed spans, then the rest after an opening, then all up to the first closing, then closings."""
    kept, rest = "", line
    while opening in rest and closing in rest.split(opening, 1)[1]:
        before, rest = rest.split(opening, 1)
        kept += before
        rest = rest.split(closing, 1)[1]
    line = (kept + rest).split(opening, 1)[0]
    line = line.split(closing, 1)[-1]
    return line.replace(closing, "")


def plain(line):
    line = _cut(_cut(line, "{{", "}}"), "<ref", "</ref>")
    return "".join(c for c in line if c in WORD | SPACE | set(".!,?"))


def pure(lines):
    return "".join(plain(line) + " " for line in lines if is_prose(line))


def ref_bodies(text):
    found = []
    for piece in text.split("</ref>")[:-1]:
        for at in range(len(piece) - 4, -1, -1):
            rest = piece[at + 4 :]
            tag, closed, _ = rest.partition(">")
            if piece.startswith("<ref", at) and rest[:1] in SPACE | {">"} and rest and not (closed and tag.endswith("/")):
                found.append(rest.removeprefix(">"))
                break
    return found


#: Raw titles and what they come to; null where the title is rejected.
TITLES = {
    "A%2CB": "A,B", "a_b": "a b", "a+b": "a+b", "a%2Bb": "a+b", "%7e": "~", "%09x": "\tx", "%2541": "A", "%252541": "A",
    "a b:c": "a b:c", "%20:": " :", "_x_": " x ", "  pad ": "pad", "": "", "été": "été",
    "A%ZZ": None, "100%": None, "%25": None, "%2525": None, "%25%34%31": None, "%4": None, "a%41%": None, "%%41": None,
    "Caf%C3%A9": None, "%00": None, "%7F": None,
    "Wikipedia:X": None, "File:x": None, "2001:_X": None, "x:y": None, ":x": None, "a%3Ab": None,
    TITLE_MARKER: TITLE_MARKER, TITLE_MARKER + "%41": TITLE_MARKER + "A", "one": "one", "y": "y", "Inside": "Inside",
} | {f"{word}_{i}": f"{word} {i}" for word in ("Good", "Far") for i in range(10)}


def dictionary_word(token):
    """The word a token is reduced to, or None."""
    runs, gap = [""], False
    for char in token:
        if char in set(string.ascii_lowercase + "'."):
            if gap and runs != [""]:
                runs.append("")
            runs[-1] += char
            gap = False
        else:
            gap = True
    if not runs[0] or len(runs) > 2 or len(runs) == 2 and len(runs[1]) > 1:
        return None
    return runs[0]


def articles(files, prefix):
    """(title, lines) of each complete article, file by file."""
    found = []
    for text in files:
        current = None
        for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
            line = "".join(c for c in line if ord(c) < 128)
            has = line.startswith if prefix else line.__contains__
            if current is None:
                if has(TITLE_MARKER):
                    name = TITLES[line.split()[-1] if prefix else line.strip().split(" ")[-1]]
                    if name is not None or not prefix:
                        current = (name, [])
            elif END_MARKER in line:
                found.append(current)
                current = None
            else:
                current[1].append(line)
    return found


def entity_tags(tokens, phrases):
    """Longest phrase at each start, left to right."""
    tagged, at = [], 0
    while at < len(tokens):
        sizes = [n for n in range(len(tokens) - at, 0, -1) if " ".join(tokens[at : at + n]) in phrases]
        n = sizes[0] if sizes else 1
        tag = phrases[" ".join(tokens[at : at + n])] if sizes else "O"
        tagged += [(t, tag) for t in tokens[at : at + n]]
        at += n
    return tagged
