"""Script form of :mod:`claimworks.job` for spark-submit."""

from claimworks.job import main

if __name__ == "__main__":
    main()
