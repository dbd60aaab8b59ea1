from .plans.job import main

raise SystemExit(main())
