from clickpulse.cli import main

main()
