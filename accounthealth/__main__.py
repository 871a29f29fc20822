from accounthealth.jobs import main

main()
