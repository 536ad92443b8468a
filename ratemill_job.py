"""Entry point for ``spark-submit``; see ``ratemill.jobs``."""

from ratemill.jobs import main

if __name__ == "__main__":
    main()
