"""Plain, slow versions of what the operators must return."""

import collections
import hashlib
import re

import xxhash

WORD = re.compile("[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def host_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup,
            len(covered), failed)


PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"),
           ("all rights reserved", "reserved")]


def license_base(text):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    places = [(i, label) for phrase, label in PHRASES for p in [phrase.split()]
              for i in range(len(words)) if words[i:i + len(p)] == p]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def pii_base(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+",
         lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15)]
    spans = [(kind, m.start(), m.end()) for kind, pattern, test in kinds
             for m in re.finditer(pattern, text) if len(m[0]) < 4000 and test(m)]
    count = collections.Counter(kind for kind, _, _ in spans)
    return (*(count[k] for k in ("email", "ip", "card", "phone")),
            sha(",".join("%s:%d:%d" % s for s in spans)), spans)


def secret_base(text):
    text = text or ""
    names = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
                     for w in ("password", "passwd", "secret", "token", "api_?key"))
    kinds = [
        ("assign", rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         lambda m: len(m[2]) >= 6),
        ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24)]
    spans = sorted((m.start(), k, m.end()) for k, (_, pattern, test) in enumerate(kinds)
                   for m in re.finditer(pattern, text) if test(m))
    named = [(kinds[k][0], a, b) for a, k, b in spans]
    count = collections.Counter(kind for kind, _, _ in named)
    return (*(count[k] for k in ("assign", "access", "hex")),
            sha(",".join("%s:%d:%d" % s for s in named)), named)


def fingerprint(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64)
               if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(prints):
    """Smallest doc_id of each row's class; prints: (doc_id, fingerprint) pairs."""
    distinct = sorted({fp for _, fp in prints})
    root = {fp: fp for fp in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                root[find(b)] = find(a)
    least = {}
    for doc, fp in prints:
        if doc is not None:
            least[find(fp)] = min(doc, least.get(find(fp), doc))
    return [(doc, f"{fp:016x}", least.get(find(fp))) for doc, fp in prints]
