"""Column naming."""

import re

# A break sits before a capital that follows a lower-case letter or digit, and before the last
# capital of a run of capitals that starts a new word. Digits stay with the word before them.
_WORD_BREAK = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[^_])(?=[A-Z][a-z])")


def snake_case(name: str) -> str:
    """``suctionPressureKpa`` -> ``suction_pressure_kpa``."""
    return _WORD_BREAK.sub("_", name).lower()
