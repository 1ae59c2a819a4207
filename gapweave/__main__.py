import sys

from gapweave.cli import main

sys.exit(main())
