"""python -m riskweave.restore ROOT RELEASE: split a saved release into one table for each component."""

from __future__ import annotations

import argparse

from riskweave.session import session
from riskweave.sources.store import Store


def main(args: list[str] | None = None) -> list[str]:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("root", help="where the store lives")
    parser.add_argument("release", help="such as 2024_Q4")
    parser.add_argument("-o", "--overwrite", action="store_true", help="replace components that are there")
    given = parser.parse_args(args)
    store = Store(session("restore"), given.root)
    return store.restore(given.release, given.overwrite)


if __name__ == "__main__":
    print("\n".join(main()))
