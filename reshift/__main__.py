from reshift.cli import main

main()
