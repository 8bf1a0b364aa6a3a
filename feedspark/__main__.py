"""``python -m feedspark --feed <name|all> --landing ... --catalog ...``"""
import sys

from .plans.job import main

sys.exit(main())
