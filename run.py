"""Entry point for ``spark-submit``; see ``harbor.jobs``."""

from harbor.jobs import main

if __name__ == "__main__":
    main()
