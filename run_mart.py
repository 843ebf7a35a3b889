"""``spark-submit run_mart.py --task … --raw … --mart …``; see ``salesmart.cli``."""

from salesmart.cli import main

if __name__ == "__main__":
    main()
