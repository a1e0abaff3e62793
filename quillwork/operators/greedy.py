"""Order-sensitive operators: what is accepted depends on what was accepted before.

Rows of a group are taken by an explicit ordinal, so the result does not depend on partitioning. A group is a block of
lessons of one source, a bounded unit of work: caps hold within a block. The candidate pools before are declarative.
"""

from __future__ import annotations

import difflib
import hashlib
from collections import Counter
from collections.abc import Iterable

import pandas as pd

LOOK_BACK, LENGTH_BAND, TOO_SIMILAR = 80, 140, 0.92


def seed_of(*parts: object) -> int:
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)


class Accepted:
    """What a group has accepted so far, with its caps."""

    def __init__(self, opening_cap: int, sentence_cap: int) -> None:
        self.openings: Counter = Counter()
        self.sentences: Counter = Counter()
        self.answers: list[str] = []
        self.prompts: set[str] = set()
        self.opening_cap, self.sentence_cap = opening_cap, sentence_cap

    def similar(self, text: str) -> bool:
        """Whether one of the last accepted answers is nearly the same; lengths far apart are not compared."""
        for old in self.answers[-LOOK_BACK:]:
            if abs(len(old) - len(text)) <= LENGTH_BAND and difflib.SequenceMatcher(None, old, text).ratio() >= TOO_SIMILAR:
                return True
        return False

    def take(self, opening: str, sentences: list[str], text: str, prompt: str) -> None:
        self.openings[opening] += 1
        self.sentences.update(sentences)
        self.answers.append(text)
        self.prompts.add(prompt)


def rotation(banks: list[list[str]], caps: Accepted, lesson: str, seed: int, attempts: int) -> tuple[str, list[str], str] | None:
    """The first combination from the rotated banks that keeps all caps, or None."""
    openings, middles, ends = banks
    for k in range(attempts):
        o, m, e = openings[(seed + k) % len(openings)], middles[(seed // 7 + 3 * k) % len(middles)], ends[(seed // 49 + 5 * k) % len(ends)]
        if caps.openings[o] >= caps.opening_cap or any(caps.sentences[s] >= caps.sentence_cap for s in (m, e)):
            continue
        text = " ".join([o, lesson, m, e])
        if not caps.similar(text):
            return o, [m, e], text
    return None


def generate(rows: pd.DataFrame, banks: list[list[str]], prompts: list[str], opening_cap: int, sentence_cap: int, attempts: int, per_lesson: int = 1, fallback: bool = False, earlier: pd.DataFrame | None = None) -> pd.DataFrame:
    """Examples for the lessons of one group in the order of their ordinal. Examples made earlier count for the caps.

    A lesson gives up to per_lesson examples of different prompts; when every combination breaks a cap the lesson
    is skipped, or with fallback gives the combination of its seed, marked as such. Blank lessons are skipped.
    """
    caps, out = Accepted(opening_cap, sentence_cap), []
    for old in earlier.sort_values(["ordinal", "variant"], kind="stable").itertuples(index=False) if earlier is not None else ():
        caps.take(old.opening, [x for b in banks[1:] for x in b if x in old.answer], old.answer, old.prompt)
    for row in rows.sort_values("ordinal", kind="stable").itertuples(index=False):
        if not isinstance(row.lesson, str) or not row.lesson.strip():
            continue
        for j in range(per_lesson):
            seed = seed_of(row.ordinal, j)
            free = [p for p in (prompts[(seed + k) % len(prompts)].replace("{x}", row.topic) for k in range(len(prompts))) if p not in caps.prompts]
            if not free:
                break
            found = rotation(banks, caps, row.lesson, seed, attempts)
            forced = found is None and fallback
            if forced:
                parts = [b[seed % len(b)] for b in banks]
                found = parts[0], parts[1:], " ".join([parts[0], row.lesson, *parts[1:]])
            if found is None:
                continue
            caps.take(found[0], found[1], found[2], free[0])
            out.append((row.source, row.ordinal, j, free[0], found[0], found[2], forced))
    return pd.DataFrame(out, columns=["source", "ordinal", "variant", "prompt", "opening", "answer", "forced"])


def fingerprint(text: str, words: int = 45) -> str:
    """The first words of a text in lower case without signs."""
    return " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split()[:words])


def generate_by_fingerprint(rows: pd.DataFrame, banks: list[list[str]], prompts: list[str], opening_cap: int = 2) -> pd.DataFrame:
    """One example a lesson: an opening fewer than opening_cap examples have (the lesson is skipped when all are used up), a prompt not used yet before one that is, and a text of which no accepted one has the fingerprint."""
    used_openings, used_prompts, prints, out = Counter(), set(), set(), []
    for row in rows.sort_values("ordinal", kind="stable").itertuples(index=False):
        if not isinstance(row.lesson, str) or not row.lesson.strip():
            continue
        seed = seed_of(row.ordinal)
        opening = next((o for o in (banks[0][(seed + k) % len(banks[0])] for k in range(len(banks[0]))) if used_openings[o] < opening_cap), None)
        if opening is None:
            continue
        options = [prompts[(seed + k) % len(prompts)].replace("{x}", row.topic) for k in range(len(prompts))]
        prompt = next((p for p in options if p not in used_prompts), options[0])
        rest = ((banks[1][(seed + k) % len(banks[1])], banks[2][(seed // 7 + k) % len(banks[2])]) for k in range(max(map(len, banks))))
        text = next((t for t in (" ".join([opening, row.lesson, m, e]) for m, e in rest) if fingerprint(t) not in prints), None)
        if text is None:
            continue
        used_openings[opening] += 1
        used_prompts.add(prompt)
        prints.add(fingerprint(text))
        out.append((row.source, row.ordinal, 0, prompt, opening, text, False))
    return pd.DataFrame(out, columns=["source", "ordinal", "variant", "prompt", "opening", "answer", "forced"])


STRUCTURES = ("opening lesson middle end", "lesson opening middle end", "middle lesson end", "opening middle lesson end")


def generate_by_family(rows: pd.DataFrame, banks: list[list[str]], prompts: dict[str, list[str]], cap: int = 3, per_lesson: int = 5, attempts: int = 24, target: int | None = None) -> pd.DataFrame:
    """Up to per_lesson examples of each lesson over its families, structures and prompts: openings and actions (the middle) in at most cap examples each, prompts and answers all different, at most `attempts` combinations for an example."""
    openings, actions, asked, answered, out = Counter(), Counter(), set(), set(), []
    for row in rows.sort_values("ordinal", kind="stable").itertuples(index=False):
        if not isinstance(row.lesson, str) or not row.lesson.strip():
            continue
        families = [f for f in row.families if f in prompts] or list(prompts)
        for j in range(per_lesson):
            if target is not None and len(out) >= target:
                break
            seed = seed_of(row.ordinal, j)
            family = families[j % len(families)]
            for k in range(attempts):
                prompt = prompts[family][(seed + k) % len(prompts[family])].replace("{x}", row.topic)
                o, m, e = banks[0][(seed + k) % len(banks[0])], banks[1][(seed // 7 + 3 * k) % len(banks[1])], banks[2][(seed // 49 + 5 * k) % len(banks[2])]
                structure = STRUCTURES[(seed + k) % len(STRUCTURES)]
                parts = {"opening": o, "lesson": row.lesson, "middle": m, "end": e}
                text = " ".join(parts[x] for x in structure.split())
                if fingerprint(prompt) in asked or fingerprint(text, 1000) in answered or ("opening" in structure and openings[o] >= cap) or actions[m] >= cap:
                    continue
                openings[o] += "opening" in structure
                actions[m] += 1
                asked.add(fingerprint(prompt))
                answered.add(fingerprint(text, 1000))
                out.append((row.source, row.ordinal, j, prompt, o if "opening" in structure else "", text, False))
                break
    return pd.DataFrame(out, columns=["source", "ordinal", "variant", "prompt", "opening", "answer", "forced"])


def capped(rows: pd.DataFrame, cap: int) -> pd.DataFrame:
    """Each row takes its best candidate (by rank) that fewer than cap rows have taken; none when all are used up."""
    used: Counter = Counter()
    out = []
    for row in rows.sort_values("ordinal", kind="stable").itertuples(index=False):
        chosen = next((c for c in row.candidates if used[c] < cap), None)
        used[chosen] += chosen is not None
        out.append((row.source, row.ordinal, chosen))
    return pd.DataFrame(out, columns=["source", "ordinal", "chosen"])


def accept_rewrites(rows: Iterable, target: int, theme_caps: dict[str, int], default_cap: int, templates: list[str]) -> list[tuple]:
    """Rewrites in the order of the rows (id, theme, place) until the target, up to the cap of a theme, with prompts not used yet.

    The rows are taken one by one and only as far as needed; a row whose prompt is refused does not count for its theme.
    """
    used, themes, out = set(), Counter(), []
    for row in rows:
        if len(out) >= target:
            break
        if themes[row.theme] >= theme_caps.get(row.theme, default_cap):
            continue
        prompt = templates[(themes[row.theme] + seed_of(row.theme)) % len(templates)].replace("{x}", f"{row.theme} {row.id % 97}")
        if prompt in used:
            continue
        used.add(prompt)
        themes[row.theme] += 1
        out.append((row.id, row.theme, prompt))
    return out
