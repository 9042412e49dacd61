"""Script for ``spark-submit``; see ``tallyframe/__main__.py``."""

from tallyframe.__main__ import main

if __name__ == "__main__":
    main()
