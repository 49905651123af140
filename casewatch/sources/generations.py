"""A table as numbered folders: changes appended one after another, now and then written whole.

A folder counts from the moment its writing has ended (its _SUCCESS file), so a broken job leaves nothing that
is read. The newest whole generation and the changes after it are the table; the generation before it stays until the
next one, for readers that are still at it.
"""

from casewatch.sources import files

CHANGES, WHOLE = "changes", "whole"


def _numbers(spark, folder):
    return sorted(int(n) for n in files.children(spark, folder) if n.isdigit())


def complete(spark, folder):
    """Numbers of the subfolders whose writing has ended, ascending."""
    return [n for n in _numbers(spark, folder) if "_SUCCESS" in files.children(spark, f"{folder}/{n}")]


def live(spark, out, below=None):
    """(number of the newest whole generation or -1, [(number, path), ...] of what the table consists of, oldest first).

    below: as it was before the whole generation of that number.
    """
    whole = [n for n in complete(spark, f"{out}/{WHOLE}") if below is None or n < below]
    base = whole[-1] if whole else -1
    parts = [(base, f"{out}/{WHOLE}/{base}")] if whole else []
    return base, parts + [(n, f"{out}/{CHANGES}/{n}") for n in complete(spark, f"{out}/{CHANGES}") if n > base]


def next_number(spark, out):
    """A number that no change has, broken ones included."""
    return max([-1, *_numbers(spark, f"{out}/{CHANGES}"), *_numbers(spark, f"{out}/{WHOLE}")]) + 1


def retire(spark, out, base):
    """Removes what the generation `base` replaced, when a newer whole one is complete."""
    for kind, limit in ((WHOLE, base - 1), (CHANGES, base)):
        for n in _numbers(spark, f"{out}/{kind}"):
            if n <= limit:
                files.remove(spark, f"{out}/{kind}/{n}")
