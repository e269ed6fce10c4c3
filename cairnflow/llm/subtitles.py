"""Reading subtitle files: what is said, apart from numbers, times and markup."""

from __future__ import annotations

import re

_MICRO = re.compile(r"\{\d*\}\{\d*\}")
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>|\{\\[^{}]*\}")
#: A web address or one's host name: names of two letters or more joined by dots, lower case, standing alone or after a scheme, "www." or "@".
_ADDRESS = re.compile(r"https?:|www\.|@\w+\.|(?<![\w.-])[a-z0-9][a-z0-9-]{2,}\.[a-z]{2,}(?:/\S*)?(?![\w.])")
#: What is done to a subtitle file, said together with by whom.
_MADE = re.compile(r"\b(?:subtitle[sd]?|subs|captions?|captioned|synced|synchroni[sz]ed|corrected|encoded|translated|transcribed|ripped)\b")
_MADE_HINTS = ("sub", "sync", "capt", "corre", "enco", "trans", "rip")
_WHOM = re.compile(r"\b(?:by|for|please)\b")
_SOUND = re.compile(r"[\[(][^\[(\])]*[\])]|[♪♫#]+|â™ª|Ã¢â„¢Âª")
_LABEL = re.compile(r"[-–—\s\"“”'«]*[^\W\d_a-zà-ÿ]{2,}: ?(?=\S)")
_BLANK = " \t\r\f\v﻿"


def cues(text: str) -> list[list[str]]:
    """The text lines of each cue; a plain transcript's paragraphs. Cue numbers, times, headers and blank lines are left out."""
    out: list[list[str]] = []
    now: list[str] = []
    for raw in text.split("\n"):
        line = raw.strip(_BLANK)
        if not line:
            if now:
                out.append(now)
                now = []
        elif "-->" in line:
            if now and now[-1].isdigit():
                now.pop()
            if now:
                out.append(now)
            now = []
        elif line[0] == "{" and (m := _MICRO.match(line)):
            if now:
                out.append(now)
            now = [part for p in line[m.end() :].split("|") if (part := p.strip(_BLANK))]
        elif not line.startswith("WEBVTT"):
            now.append(line)
    if now:
        out.append(now)
    return out


#: Three times one sign that frames or rules a line.
_FRAME = re.compile(r"([^\w\s.?!\-–—♪♫#])\1\1")


def advertises(line: str) -> bool:
    """A line about the file itself or another offer: an address, a credit, or a text framed by rows of one sign."""
    if ("." in line or "@" in line or "http" in line) and _ADDRESS.search(line):
        return True
    low = line.lower()
    if any(h in low for h in _MADE_HINTS) and _MADE.search(low) and _WHOM.search(low):
        return True
    frame = _FRAME.match(line)
    return frame is not None and frame[0] in line.lstrip(frame[1])


def may_advertise(text: str) -> bool:
    """False only where no line of the text advertises."""
    return _ADDRESS.search(text) is not None or _MADE.search(text.lower()) is not None or _FRAME.search(text) is not None


def unlabelled(line: str) -> str:
    """Without the label of the speaker at its start: a word in capitals and a colon."""
    label = _LABEL.match(line)
    return line[label.end() :] if label else line


def untagged(line: str) -> str:
    return _TAG.sub("", line).strip(_BLANK) if "<" in line or "{" in line else line


def without_sounds(line: str) -> str:
    return _SOUND.sub(" ", line) if "[" in line or "(" in line or not line.isascii() or "#" in line else line


_HIGH = re.compile(r"[^\x00-\x7f]+")
_BYTES = {chr(i): i for i in range(256)}
for _i in range(0x80, 0xA0):
    try:
        _BYTES[bytes([_i]).decode("cp1252")] = _i
    except UnicodeDecodeError:
        pass


def _reread(run: re.Match) -> str:
    text = run.group()
    for _ in range(3):
        try:
            text = bytes([_BYTES[c] for c in text]).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            break
        if text.isascii():
            break
    return text


def reread(text: str) -> str:
    """UTF-8 that was read as a one-byte encoding, once or repeatedly, read as UTF-8 again; anything else unchanged."""
    if "Ã" in text or "â" in text or "Â" in text:
        return _HIGH.sub(_reread, text)
    return text
