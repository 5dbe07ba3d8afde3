"""Launcher for ``spark-submit``: this folder is on the path, so the package is found."""

import sys

from tickloom.jobs import main

if __name__ == "__main__":
    sys.exit(main())
