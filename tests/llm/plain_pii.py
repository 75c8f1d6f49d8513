"""Pseudonyms one text at a time, in plain Python."""

import datetime
import hashlib
import re

from tabspark.llm import pii

RANGE = {"0": 10, "a": 26}


def prf(key, tag, *parts):
    return int(hashlib.md5("|".join([key, tag, *map(str, parts)]).encode()).hexdigest()[:7], 16)


def chars(text, key, tag, capitals=26):
    def shifted(a, b, r):
        out = ""
        for i, c in enumerate(a):
            for base, n in (("0", 10), ("a", 26), ("A", capitals)):
                if ord(base) <= ord(c) < ord(base) + n:
                    c = chr(ord(base) + (ord(c) - ord(base) + prf(key, tag, r, i, b)) % n)
                    break
            out += c
        return out
    h = len(text) // 2
    for r in range(pii.ROUNDS):
        a, b = text[:h], text[h:]
        text = shifted(a, b, r) + b if r % 2 == 0 else a + shifted(b, a, r)
    return text


def pair(a, b, m, n, key, tag, *salt):
    for r in range(pii.ROUNDS):
        if r % 2 == 0:
            a = (a + prf(key, tag, r, b, *salt)) % m
        else:
            b = (b + prf(key, tag, r, a, *salt)) % n
    return a, b


def digits(m):
    return "".join(c for c in m if c in "0123456789")


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def refill(m, d):
    it = iter(d)
    return "".join(next(it) if c in "0123456789" else c for c in m)


def card(m, key):
    d = digits(m)
    body = chars(d[:-1], key, "card")
    return refill(m, body + next(x for x in "0123456789" if luhn(body + x)))


def phone(m, key):
    start = len(re.match(r"^(?:\+?1[ .-]?(?=[(0-9]))?", m)[0])
    own = m[start:]
    d = digits(own)
    there, back = str.maketrans("0123456789", "!#ABCDEFGH"), str.maketrans("!#ABCDEFGH", "0123456789")
    return m[:start] + refill(own, chars(d[0].translate(there) + d[1:3] + d[3].translate(there) + d[4:], key, "phone", 8).translate(back))


def day_of(m):
    a, b, c = re.split("[-/.]", m)
    for y, mo, d in [(a, b, c)] if len(a) == 4 else [(c, a, b), (c, b, a)] if "/" in m else [(c, b, a)]:
        try:
            return datetime.date(int(y), int(mo), int(d))
        except ValueError:
            pass
    return None


def date(m, key):
    first, size = datetime.date(1600, 1, 1), pii.BLOCK_L * pii.BLOCK_R
    own = now = day_of(m)
    while True:
        block, at = divmod((now - first).days, size)
        a, b = pair(at // pii.BLOCK_R, at % pii.BLOCK_R, pii.BLOCK_L, pii.BLOCK_R, key, "date", block)
        now = first + datetime.timedelta(days=block * size + a * pii.BLOCK_R + b)
        if (now.day > 12) == (own.day > 12):
            break
    a, b, _ = re.split("[-/.]", m)
    year, month, day = f"{now.year:04d}", f"{now.month:02d}", f"{now.day:02d}"
    if len(m) < 10:
        month, day = str(now.month), str(now.day)
    if len(a) == 4:
        return ("-" if "-" in m else "/").join([year, month, day])
    if "." in m:
        return f"{day}.{month}.{year}"
    return f"{day}/{month}/{year}" if int(a) > 12 else f"{month}/{day}/{year}"


def ssn(m, key):
    a, b, c = map(int, m.split("-"))
    x, y = pair(a - 2 if a > 666 else a - 1, (b - 1) * pii.SERIALS + c - 1, 898, 99 * pii.SERIALS, key, "ssn")
    x += 1
    return f"{x + (x >= 666):03d}-{y // pii.SERIALS + 1:02d}-{y % pii.SERIALS + 1:04d}"


def ipv4(m, key):
    a, b, c, d = map(int, m.split("."))
    x, y = pair(a * 256 + b, c * 256 + d, 65536, 65536, key, "ipv4")
    return f"{x // 256}.{x % 256}.{y // 256}.{y % 256}"


def cards(text):
    """Spans of the cards in runs of digits."""
    shapes = [re.compile(f"((?:{s.replace('TAKEN', pii.TAKEN)}))(?![0-9])") for s in (pii.SHAPE, pii.LONG)]
    found = []
    for run in re.finditer(pii.BEFORE, text):
        if not re.fullmatch(pii.RUN, run[0]):
            continue
        for group in re.finditer("[0-9]+", run[0]):
            at = run.start() + group.start()
            if found and at < found[-1][1]:
                continue
            # what follows the run counts only as far as one character behind a slash or dot
            end = run.end() + (2 if re.match("[/.][0-9]", text[run.end():]) else 0)
            hits = [m for s in shapes if (m := s.match(text[:end], at)) and luhn(digits(m[0]))]
            if hits:
                found.append(hits[0].span())
    return found


def pseudonymise(text, key):
    """The text with pseudonyms, and the kinds found."""
    spans = cards(text)
    marked, at = "", 0
    for a, b in spans:
        marked += text[at:a] + pii.OPEN + text[a:b] + pii.CLOSE
        at = b
    marked += text[at:]
    kinds = []

    def new(match):
        m = match[0]
        day = day_of(m) if re.fullmatch(pii.DATE, m) else None
        if m.startswith(pii.OPEN):
            kind, out = "card", card(m[1:-1], key)
        elif "@" in m:
            local = m.index("@")
            kind, out = "email", chars(m[:local], key, "email") + m[local:]
        elif re.fullmatch(pii.IPV4, m) and all(int(o) <= 255 for o in m.split(".")):
            kind, out = "ipv4", ipv4(m, key)
        elif re.fullmatch(pii.SSN, m):
            a, b, c = map(int, m.split("-"))
            kind, out = ("ssn", ssn(m, key)) if 0 < a < 900 and a != 666 and b and c else (None, m)
        elif re.fullmatch(pii.PHONE, m):
            kind, out = "phone", phone(m, key)
        elif day and 1600 <= day.year <= 9900:
            kind, out = "date", date(m, key)
        elif re.fullmatch(pii.CARD, m) and luhn(digits(m)):
            kind, out = "card", card(m, key)
        else:
            return m
        kinds.append(kind)
        return out

    return re.sub(pii.ANY, new, marked), kinds
