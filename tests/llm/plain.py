"""The operators' results in plain Python, for small tables."""

import hashlib
import math
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import accumulate, combinations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def line_dedup(texts, least=10):
    """By place in ``texts`` (doc_id, text), rows equal in both being one document."""

    def key(line):
        return line.strip(" \t\n\x0b\f\r").translate(LOWER)

    counts = Counter()
    for _, text in set(texts):
        counts.update({key(line) for line in (text or "").split("\n")})
    for doc_id, text in texts:
        lines = (text or "").split("\n")
        kept = [line for line in lines if not (key(line) and counts[key(line)] >= least)]
        yield doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))


def secrets(texts):
    for doc_id, text in texts:
        text = text or ""
        kinds = (
            [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6],
            [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20],
            [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24],
        )
        spans = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(sum(kinds, [])))
        yield doc_id, *map(len, kinds), sha(spans)


def repeats(texts, length=400):
    data = [(doc_id, (text or "").encode()) for doc_id, text in texts]
    counts = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    for doc_id, b in data:
        covered = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(covered)))
        yield doc_id, len(b), sum(covered), spans, sha(bytes(x for x, gone in zip(b, covered) if not gone))


def contamination(texts, items):
    windows = defaultdict(set)
    for item_id, text in items:
        item = words(text)
        size = min(10, len(item))
        for i in range(len(item) - size + 1 if item else 0):
            windows[tuple(item[i : i + size])].add(item_id)
    sizes = {len(window) for window in windows}
    for doc_id, text in texts:
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                ids = windows.get(tuple(own[i : i + size]))
                if ids is not None:
                    hit.update(range(i, i + size))
                    found |= {str(x) for x in ids if x is not None}
        yield doc_id, len(own), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def damped(counts):
    return {key: 1 + math.log(n) for key, n in counts.items()}


def probability_jaccard(a, b):
    both = set(a) | set(b)
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in both) for d in set(a) & set(b))


def classes(texts, threshold=0.8):
    """Least identifier and size of each document's class."""
    sets = []
    for _, text in texts:
        own = words(text)
        runs = [tuple(own[i : i + 5]) for i in range(len(own) - 4)] if len(own) >= 5 else [tuple(own)] if own else []
        sets.append(Counter(runs))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        if (texts[a][1] or "") == (texts[b][1] or ""):
            parent[find(a)] = find(b)
        elif sets[a].keys() & sets[b].keys() and probability_jaccard(damped(sets[a]), damped(sets[b])) >= threshold:
            parent[find(a)] = find(b)
    members = defaultdict(list)
    for place in range(len(texts)):
        members[find(place)].append(texts[place][0])
    least = {root: min((x for x in ids if x is not None), default=None) for root, ids in members.items()}
    return [(texts[place][0], least[find(place)], len(members[find(place)])) for place in range(len(texts))]


def edited(texts):
    """n_chars and the hash of the edited text, by doc_id; identifiers differ."""
    order = sorted((doc_id, text or "") for doc_id, text in texts)
    for place, (doc_id, text) in enumerate(order):
        quarter = len(text) // 4
        following = order[(place + 1) % len(order)][1]
        yield doc_id, len(text), sha(text[: len(text) - quarter] + following[:quarter])


RUN = re.compile(r"[^\x20\x09-\x0D]+")


def repeated_words(texts, size=13):
    own = [(doc_id, RUN.findall(text or "")) for doc_id, text in texts]
    least = {}
    for doc_id, found in own:
        for i in range(len(found) - size + 1) if doc_id is not None else ():
            window = tuple(found[i : i + size])
            least[window] = min(least.get(window, doc_id), doc_id)
    for doc_id, found in own:
        gone = set()
        for i in range(len(found) - size + 1) if doc_id is not None else ():
            if least[tuple(found[i : i + size])] < doc_id:
                gone.update(range(i, i + size))
        kept = [word for i, word in enumerate(found) if i not in gone]
        yield doc_id, len(found), len(gone), sha(" ".join(kept))


def ends_of(lengths):
    return list(accumulate(lengths))


def alignment(texts, encode_a, encode_b, bytes_a, bytes_b):
    """By document: counts, best links, sum of counts and the list of groups; by pair, the number of documents."""
    listed, counts = [], Counter()
    for doc_id, text in texts:
        groups = []
        if text:
            whole = f" {text}".encode()
            a, b = encode_a(f" {text}"), encode_b(text)
            if b"".join(map(bytes_a, a)) == whole and b"".join(map(bytes_b, b)) == whole:
                ends_a, ends_b = ends_of(len(bytes_a(x)) for x in a), ends_of(len(bytes_b(x)) for x in b)
                both = sorted(set(ends_a) & set(ends_b))
                groups = [([], []) for _ in both]
                for ids, ends, side in ((a, ends_a, 0), (b, ends_b, 1)):
                    for number, end in zip(ids, ends):
                        groups[bisect_left(both, end)][side].append(number)
        links = Counter((x, y) for a, b in groups for x in a for y in b)
        counts.update(links.keys())
        listed.append((doc_id, groups, links))
    highest = Counter()
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    rows = []
    for doc_id, groups, links in listed:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append(
            (
                doc_id,
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                sum(links.values()),
                sum(n for pair, n in links.items() if counts[pair] == highest[pair[0]]),
                sum(n * counts[pair] for pair, n in links.items()),
                sha(text) if groups else "",
            )
        )
    return rows, counts


def damage(rows):
    for conv_id, turn, role, text in rows:
        conv, at, role, text = (" " if value is None else str(value) for value in (conv_id, turn, role, text))
        how = zlib.crc32(f"{conv}:{at}".encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        role = "user" if how == 4 else role
        for _ in range({0: 0, 3: 2}.get(how, 1)):
            yield conv_id, turn, role, text


def cheapest_edits(kinds):
    """Cost and audit over all edits, audits written out for every state; ``kinds`` are (initial, fault), fault 2 goes."""
    states = {"": (0, "")}
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    def put(found, state, value):
        found[state] = min(found.get(state, value), value)

    def inserted(found):
        found = dict(found)
        for _ in range(3):
            for state, (cost, audit) in list(found.items()):
                put(found, after[state], (cost + 2, audit + "I"))
        return found

    for initial, fault in kinds:
        found = {}
        for state, (cost, audit) in inserted(states).items():
            put(found, state, (cost + 3, audit + "D"))
            if fault != 2:
                put(found, after[state], (cost + 2 + fault, audit + "R"))
                if initial == after[state] or (initial, state) == ("s", ""):
                    put(found, initial, (cost + fault, audit + "K"))
        states = found
    found = inserted(states)
    return min(found[state] for state in ("", "a") if state in found)


def conversations(given):
    """The report of every conversation of ``given`` (conv_id, turn, role, text) after damage."""
    held = {row[0]: [] for row in given}
    for row in damage(given):
        held[row[0]].append(row[1:])
    for conv_id, rows in held.items():
        rows.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1], row[2]))
        faults, seen, kinds = Counter(), set(), []
        for _, role, text in rows:
            last = text.rstrip(" \t\n\x0b\f\r")[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated"
            seen.add((role, text))
            faults[fault] += 1
            kinds.append((role[:1], {"": 0, "truncated": 1}.get(fault, 2)))
        cost, audit = cheapest_edits(kinds)
        turns = {row[0] for row in rows} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        state, left, ahead = "", [], iter(rows)
        for edit in audit:
            _, role, text = (None, None, "") if edit == "I" else next(ahead)
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if state == "u" else "user"
            state = role[:1]
            left.append(f"{role}:{text}")
        yield conv_id, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha("\n".join(left))


def mixing_targets(sizes, weights=(5, 2, 1), most=3):
    """``sizes`` by source; sources in order, None last."""
    order = sorted(sizes, key=lambda source: (source is None, source or ""))
    weight = {source: weights[place % len(weights)] for place, source in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        free = [source for source in order if source not in full]
        level = (total - sum(most * sizes[s] for s in full)) / sum(weight[s] for s in free) if free else 0
        over = {source for source in free if weight[source] * level > most * sizes[source]}
        if not over:
            return {s: most * sizes[s] if s in full else weight[s] * level for s in order}
        full |= over


def uniform(number, level):
    value, most = (number + (level + 1) * 0x9E3779B97F4A7C15) % 2**64, 2**64
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        value = (value ^ value >> shift) * factor % most
    return (value >> 11) / 2**53


def pivotal(rows, level, last):
    """``rows`` are [rid, hash, size, mass] of one block; masses become 0 or the size, but for one at most."""
    rows = sorted(rows, key=lambda row: (-row[2], row[1], row[0]))
    left = None
    for row in rows:
        if left is None:
            left = row
            continue
        up, down = min(left[2] - left[3], row[3]), min(left[3], row[2] - row[3])
        move = up if uniform(row[1], level) * (up + down) < down else -down
        left[3], row[3] = left[3] + move, row[3] - move
        for side in (left, row):
            if min(side[3], side[2] - side[3]) <= 1e-9 * max(left[2], row[2]):
                side[3] = 0.0 if side[3] < side[2] / 2 else float(side[2])
        open_rows = [side for side in (left, row) if 0 < side[3] < side[2]]
        left = open_rows[-1] if open_rows else None
    for row in rows:
        if last:
            row[3] = float(row[2]) if 2 * row[3] >= row[2] else 0.0
    return rows


def mixing(items, block_size, fan):
    """Copies by rid, for ``items`` (rid, source, hash, size)."""
    sizes, documents = Counter(), Counter()
    for _, source, _, size in items:
        sizes[source] += size
        documents[source] += 1
    goals, copies, blocks = mixing_targets(sizes), {}, defaultdict(list)
    for rid, source, number, size in items:
        rate = goals[source] / sizes[source] if sizes[source] else 0
        copies[rid] = math.floor(rate) if size else 0
        if size and rate > math.floor(rate):
            block = number % -(-documents[source] // block_size)
            blocks[source, block].append([rid, number, size, (rate - math.floor(rate)) * size])
    count, level = -(-max(documents.values()) // block_size), 0
    while True:
        last, following = count <= 1, defaultdict(list)
        for (source, block), rows in blocks.items():
            for row in pivotal(rows, level, last):
                if 0 < row[3] < row[2]:
                    following[source, block // fan].append(row)
                else:
                    copies[row[0]] += row[3] > 0
        if last:
            return copies
        blocks, count, level = following, -(-count // fan), level + 1


PAD = "\x02"


def letters(text):
    """Lower case, three pads before, every run of other characters one space, and one at the end."""
    out, after_letter = [], False
    for character in PAD * 3 + text.lower() + " ":
        letter = character.isalpha() or character == PAD
        if letter or after_letter:
            out.append(character if letter else " ")
        after_letter = letter
    return "".join(out)


class KneserNey:
    """One language's interpolated character model of order 4; ``symbols`` is the size of all languages' alphabet."""

    def __init__(self, texts):
        runs = [letters(text) for text in texts]
        self.orders = {4: Counter(run[i : i + 4] for run in runs for i in range(len(run) - 3))}
        for size in (3, 2, 1):
            self.orders[size] = Counter(gram[1:] for gram in self.orders[size + 1])
        self.discount, self.total, self.kinds = {}, Counter(), Counter()
        for size, counts in self.orders.items():
            kinds = Counter(counts.values())
            self.discount[size] = kinds[1] / (kinds[1] + 2 * kinds[2]) if kinds[1] and kinds[2] else 0.5
            for gram, n in counts.items():
                self.total[size, gram[:-1]] += n
                self.kinds[size, gram[:-1]] += 1

    def probability(self, gram, symbols):
        if not gram:
            return 1 / symbols
        size, lower = len(gram), self.probability(gram[1:], symbols)
        total = self.total[size, gram[:-1]]
        if not total:
            return lower
        discount = self.discount[size]
        own = max(self.orders[size][gram] - discount, 0)
        return (own + discount * self.kinds[size, gram[:-1]] * lower) / total

    def entropy(self, text, symbols):
        run = letters(text)
        logs = [math.log(self.probability(run[i - 3 : i + 1], symbols)) for i in range(3, len(run)) if run[i] != PAD]
        return -sum(logs) / len(logs)


def languages(learned, texts):
    """Per text its language and least cross-entropy, under models of ``learned`` (lang, text)."""
    by_lang = defaultdict(list)
    for lang, text in learned:
        by_lang[lang].append(text)
    models = {lang: KneserNey(own) for lang, own in by_lang.items()}
    symbols = len({gram for model in models.values() for gram in model.orders[1]}) + 1
    for text in texts:
        if not any(character.isalpha() for character in text or ""):
            yield "und", None
        else:
            entropy, lang = min((model.entropy(text, symbols), lang) for lang, model in models.items())
            yield lang, entropy
