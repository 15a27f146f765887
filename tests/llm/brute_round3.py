"""Brute-force versions of the prefix trie, the tokenizer alignment and the base patterns of personal data."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rebuilt(rows, every=20, most=4):
    """conv_id -> turns (role, text) of rows (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0), sha(f"{len(role)}:{role}{text}"), (role, text)))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - int(abs(c) % every) * (1 if c > 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie(convs):
    """Rows of the prefix trie of conv_id -> turns."""
    members, ends, children = defaultdict(set), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = Counter(), Counter()
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(held) - 1) * (len(BLANK.findall(node[-1][1])) if node else 0)
    out = set()
    for node, held in members.items():
        parent = min(members[node[:-1]]) if node else None
        digest = sha(",".join(map(str, sorted(ends[node]))))
        out.add((min(held), len(node), parent, len(held), len(children[node]), leaves[node], saved[node], digest))
    return out


def tokens_of(text, a_path, b_path, cache={}):
    """(ids, byte strings) of both tokenizers, or None where they do not spell the space and the text."""
    if "a" not in cache:
        import sentencepiece
        from tokenizers import Tokenizer

        cache["a"] = Tokenizer.from_file(a_path)
        cache["a"].encode_special_tokens = True
        cache["b"] = sentencepiece.SentencePieceProcessor(model_file=b_path)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        cache["back"] = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    if not text:
        return None
    a, b, back = cache["a"], cache["b"], cache["back"]
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    spelled_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
    spelled_b = [bytes([int(p[3:-1], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ids_b)]
    whole = (" " + text).encode()
    return ((ids_a, spelled_a), (ids_b, spelled_b)) if b"".join(spelled_a) == whole == b"".join(spelled_b) else None


def alignment(texts, a_path, b_path):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    parts, holders = [], Counter()
    for text in texts:
        found = tokens_of(text, a_path, b_path)
        if found is None:
            parts.append(None)
            continue
        (ids_a, by_a), (ids_b, by_b) = found
        ends = []
        for spelled in (by_a, by_b):
            at, out = 0, []
            for s in spelled:
                at += len(s)
                out.append(at)
            ends.append(out)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        for cut in cuts:
            some, others = [], []
            while i < len(ids_a) and ends[0][i] <= cut:
                some.append(ids_a[i])
                i += 1
            while j < len(ids_b) and ends[1][j] <= cut:
                others.append(ids_b[j])
                j += 1
            groups.append((some, others))
        links = Counter((x, y) for some, others in groups for x in some for y in others)
        holders.update(links.keys())
        parts.append((len(ids_a), len(ids_b), groups, links))
    best = defaultdict(int)
    for (x, _), n in holders.items():
        best[x] = max(best[x], n)
    out = []
    for part in parts:
        if part is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = part
        text = ";".join(",".join(map(str, some)) + "|" + ",".join(map(str, others)) for some, others in groups)
        n_best = sum(n for pair, n in links.items() if holders[pair] == best[pair[0]])
        out.append((n_a, n_b, len(groups), sum(links.values()), n_best, sum(n * holders[pair] for pair, n in links.items()), sha(text)))
    return out


def personal(text):
    """(kind, start, end) of the base patterns as the contract words them."""
    text = text or ""
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9) for i, d in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return spans


def languages(learned, texts, longest=5):
    """(language, score) of texts, from rows (lang, text): words first, then shorter and shorter n-grams."""
    import math

    def words(text):
        return Counter("".join(c if c.isalpha() else " " for c in (text or "").lower()).split())

    def grams(word, length):
        marked = f"<{word}>" if length > 1 else word
        return [marked[i : i + length] for i in range(len(marked) - length + 1)]

    langs = sorted({lang for lang, text in learned if lang is not None and text is not None})
    counts = [defaultdict(lambda: [0.5] * len(langs)) for _ in range(longest + 1)]
    for lang, text in {(lang, text) for lang, text in learned if lang in langs and text is not None}:
        for word, n in words(text).items():
            for length in range(longest + 1):
                for token in grams(word, length) if length else [word]:
                    counts[length][token][langs.index(lang)] += n
    sums = [[sum(v[i] for v in table.values()) for i in range(len(langs))] for table in counts]
    logs = [{t: [math.log(x / s) for x, s in zip(v, sums[k])] for t, v in table.items()} for k, table in enumerate(counts)]
    out = []
    for text in texts:
        total = [0.0] * len(langs)
        for word, n in words(text).items():
            each = [logs[0][word]] if word in logs[0] else next((k for length in range(longest, 0, -1) if (k := [logs[length][g] for g in grams(word, length) if g in logs[length]])), [])
            for i in range(len(langs)):
                total[i] += n * sum(v[i] for v in each) / max(len(each), 1)
        best = total.index(max(total)) if langs else 0
        out.append((langs[best], 1 / sum(math.exp(t - total[best]) for t in total)) if words(text) and langs else ("und", 0.0))
    return out
