import sys

from marquee.cli import main

sys.exit(main())
