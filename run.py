"""File to hand to ``spark-submit``; see ``python run.py --help``."""

from eventlake.__main__ import main

if __name__ == "__main__":
    main()
