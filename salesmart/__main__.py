from salesmart.cli import main

main()
