import sys

from candlewick.cli import main

sys.exit(main())
