"""Command line of the jobs, for ``spark-submit``."""

from corpusml.jobs import main

if __name__ == "__main__":
    main()
