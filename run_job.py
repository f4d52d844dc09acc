"""Launcher of the streaming job for spark-submit; see README.md."""

from tillwright.__main__ import main

if __name__ == "__main__":
    main()
