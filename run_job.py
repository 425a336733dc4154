"""``spark-submit --py-files tillroll.zip run_job.py batch --new-files … --archive … --batch-id …``"""

from tillroll.jobs import main

if __name__ == "__main__":
    main()
