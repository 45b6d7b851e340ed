"""Generators of the catalogue: answers by rules, as no model is shipped.

Each is made by a function, so that it travels to workers by value.
"""

from __future__ import annotations

from collections.abc import Callable

MODEL = "rules"
CHECKS = {
    "R1": "compare the amount with other claims",
    "R2": "have the damage inspected",
    "R3": "read the earlier claims of the policy",
    "R4": "ask why it was reported late",
    "R5": "ask for a police report or a witness",
}
CAUSES = {
    "null": "the source left the value out",
    "not found": "the row referred to is missing or in quarantine itself",
    "duplicate": "one value was entered twice",
    "negative": "a sign is wrong",
    "invalid": "the value is outside its domain or of another format",
}


def by_rules(start: str, after: str, answers: dict[str, str], otherwise: str) -> Callable[[str], str]:
    """``start`` and the answers to all keys named behind ``after``, else ``otherwise``."""

    def generator(prompt: str) -> str:
        told = prompt.partition(after)[2].lower()
        found = [answer for key, answer in answers.items() if key.lower() in told]
        return f"{start}{'; '.join(found) or otherwise}."

    return generator


def in_words(after: str) -> Callable[[str], str]:
    """What stands before ``after``, and the figures of the JSON behind it as a sentence."""

    def generator(prompt: str) -> str:
        import json

        subject, _, rest = prompt.partition(after)
        figures = json.loads(rest[: rest.rindex("}") + 1], parse_int=str, parse_float=str)
        told = [f"{name.replace('_', ' ')} {value}" for name, value in figures.items()]
        return f"{subject}: {', '.join(told)}."

    return generator
