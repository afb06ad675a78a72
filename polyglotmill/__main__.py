from .plans.translation import main

main()
