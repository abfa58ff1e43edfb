"""Production / non-production classes of an environment label."""

from __future__ import annotations

PROD = "PROD"
NON_PROD = "NON-PROD"
CLASSES = (PROD, NON_PROD)

_TESTS = {"exact": "{0} = 'PROD'", "prefix": "startswith({0}, 'PROD')", "contains": "contains({0}, 'PROD')"}


def classify_environment(label: str = "environment", mode: str = "exact") -> str:
    """PROD or NON-PROD; a NULL label is NON-PROD.

    ``contains`` also takes ``NON-PROD`` for production, which is how the documented
    daily-average view treats it; ``prefix`` and ``exact`` do not.
    """
    return f"if({_TESTS[mode].format(label)}, 'PROD', 'NON-PROD')"
